"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines, components.

Equal vectors of a label are one class (their cosine is 1), represented by the least vec_id, so a
vector with many copies is compared once. A representative gets one signature per table; those that
share label, table and signature are compared exactly, in double precision, in blocks of bounded
size. A pair is counted in the first table in which it meets, so no list of pairs is needed to
count links. Blocks return counts and a spanning set of their links, never all pairs.

Signature length follows the number of rows, so buckets stay small as tables grow; the number of
tables follows the length, so that a pair at the threshold is met with probability ``recall``.

Defined results: vectors that are null, zero, empty or hold null or non-finite components, vectors
without a label, and rows without a vec_id link with nothing (n_links 0, their own component,
kept). Vectors of different lengths do not link. Rows that repeat a vec_id are the same vector.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import connected, saved, table

BLOCK = 1024          # vectors compared at once in a task
ROWS_PER_BUCKET = 64  # aimed at by the signature length


def plan_tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, tables) for n vectors."""
    bits = min(30, max(8, math.ceil(math.log2(max(2, n / ROWS_PER_BUCKET)))))
    met = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _signer(bits: int, tables: int, seed: int):
    """Arrow batches of (rep, label, vec) to the same with ``sig``: one bigint per table."""
    def sign(batches):
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            vec = batch.column("vec")
            sizes = np.asarray(vec.value_lengths())
            flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            sig = np.zeros((len(sizes), tables), np.int64)
            for dim in np.unique(sizes):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((dim, bits * tables))
                at = np.flatnonzero(sizes == dim)
                rows = flat[starts[at][:, None] + np.arange(dim)]
                rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # else products of tiny numbers vanish
                sig[at] = ((rows @ planes[dim] > 0).reshape(len(at), tables, bits) * weights).sum(axis=2)
            lists = pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * tables, pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("label"), batch.column("weight"), vec,
                                              lists], names=["rep", "label", "weight", "vec", "sig"])
    return sign


def _unit(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _compare(threshold: float):
    """One pair of blocks of a bucket: links counted per vector, and a spanning set of them."""
    def compare(group: pa.Table) -> pa.Table:
        rep = group["rep"].to_numpy()
        weight = group["weight"].to_numpy()
        block = group["block"].to_numpy()
        t = group["t"][0].as_py()
        first, last = group["lo"][0].as_py(), group["hi"][0].as_py()
        vec = _unit(group["vec"])
        sig = group["sig"].combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == last)
        links = np.zeros(len(rep), np.int64)
        root = np.arange(len(rep))
        for at in range(0, len(left), BLOCK):
            rows = left[at:at + BLOCK]
            close = vec[rows] @ vec[right].T >= threshold - 1e-9
            near = np.argwhere(close)
            a, b = rows[near[:, 0]], right[near[:, 1]]
            keep = (a < b) if first == last else np.ones(len(a), bool)
            a, b = a[keep], b[keep]
            # the same sum for either order and any block: decides at the threshold
            a, b = (x[np.einsum("ij,ij->i", vec[a], vec[b]) >= threshold] for x in (a, b))
            if t:  # counted in an earlier table if they met there
                new = ~(sig[a, :t] == sig[b, :t]).any(axis=1)
                a, b = a[new], b[new]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            while True:  # spanning set: least member reachable by links of this block
                low = np.minimum(root[a], root[b])
                before = root.copy()
                np.minimum.at(root, a, low)
                np.minimum.at(root, b, low)
                root = root[root]
                if (root == before).all():
                    break
        some = np.flatnonzero((links > 0) | (root != np.arange(len(rep))))
        return pa.table({"rep": rep[some], "links": links[some], "other": rep[root[some]]})
    return compare


def near_vectors(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.999, seed: int = 7,
                 vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                          F.col(f"`{label}`").alias("label"),
                          F.transform(F.col(f"`{embedding}`"), lambda x: x.cast("double")).alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~F.coalesce(bad, F.lit(True))
                        & F.exists("vec", lambda x: x != 0))
    # -0.0 and 0.0 are the same component
    usable = usable.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
    classes = saved(usable.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"),
                                                       F.count_distinct("vec_id").alias("weight")), "op9-classes")
    bits, tables = plan_tables(classes.count(), threshold, recall)
    kind = dict(classes.dtypes)["label"]
    signed = saved(classes.select("rep", "label", "weight", "vec").mapInArrow(
        _signer(bits, tables, seed), f"rep long, label {kind}, weight long, vec array<double>, sig array<long>"),
        "op9-signed")
    spread = signed.select("rep", "label", F.size("vec").alias("dim"), F.posexplode("sig").alias("t", "s"))
    sizes = spread.groupBy("label", "dim", "t", "s").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    keyed = (spread.join(sizes, ["label", "dim", "t", "s"])
             .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int")))
    # every pair of blocks meets once: a row goes to the pairs that hold its block
    met = (keyed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("rep", "t", "label", "dim", "s", "block", F.least("block", "o").alias("lo"),
                   F.greatest("block", "o").alias("hi")))
    pairs = met.join(signed.select("rep", "weight", "vec", "sig"), "rep")
    found = saved(pairs.groupBy("label", "dim", "t", "s", "lo", "hi").applyInArrow(
        _compare(threshold), "rep long, links long, other long"), "op9-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected(found, "rep", "other").withColumnRenamed("node", "rep")
    per_class = classes.join(counts, "rep", "left").join(roots, "rep", "left").select(
        "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("root"))
    members = usable.select("vec_id", "label", "vec").distinct()
    done = members.join(per_class, ["label", "vec"]).groupBy("vec_id").agg(
        F.max("n_links").alias("n_links"), F.min("root").alias("root"))
    return (vectors.select(F.col(f"`{vec_id}`").alias("vec_id")).join(done, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("root", F.col("vec_id").cast("long")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))

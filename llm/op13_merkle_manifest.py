"""Merkle manifest of a dataset: a root over all rows, and for every row the siblings that prove it.

Rows are leaves, ordered by key within their part (here: documents by doc_id within lang). Every 8
consecutive nodes become one hash until a part has one, and the parts' roots become the root likewise.

Ranks come from one range exchange of the leaves (hashes, not texts) and the row counts of its
partitions. A rank's octal digits are columns; a block holds the 512 nodes that differ in the last three.
Each digit is grouped away in turn, which hashes runs of nodes and nests them as child structs, all within
one exchange by block. Blocks' hashes are the nodes of the next round, until a part is one block. Then
paths come down again: a block's own siblings are read off its nested structs by transform and explode,
what is above it meets it in one grouping by block. No node is joined with its siblings.

Defined results: nulls are part of a leaf as ``-``; a null part or key comes first; rows that repeat a key
follow each other by leaf; equal rows are equal leaves at different places; empty and long texts are
hashed whole (their hash alone goes on); an empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from llm.common import lower_ascii, saved, table

FAN_OUT = 8
DIGITS = 3                  # digits of a rank that one round groups away
BLOCK = FAN_OUT ** DIGITS   # nodes nested in one row
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(values: Sequence[Column]) -> Column:
    """Hash of a row's values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def ranked(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Add ``rank`` (from 0 within ``part``, by ``order``) and ``n`` (rows of the part).

    A range exchange sorts all parts together, so a large part is many tasks; a row's rank is its place
    in its task's part of the part plus the counts of the tasks before. Rows are numbered first, so
    that equal ones can be dealt apart as well.
    """
    held = saved(rows.withColumn("number", F.monotonically_increasing_id()), f"op13-{label}")
    by = ["part", *order, "number"]
    laid = saved(held.repartitionByRange(*by).sortWithinPartitions(*by).drop("number")
                 .withColumn("place", F.monotonically_increasing_id()), f"op13-{label}-sorted")
    laid = laid.withColumn("task", F.shiftright("place", 33))  # tasks number their rows from task * 2^33
    counts = laid.groupBy("part", "task").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("m"))
    # one row per task and part: bounded by the tasks and parts, not by the rows
    before = ("sum(m) over (partition by part order by task rows between unbounded preceding and 1 preceding)")
    counts = counts.select(F.col("part").alias("of"), F.col("task").alias("in"), "first",
                           F.coalesce(F.expr(before), F.lit(0)).alias("before"), F.expr("sum(m) over (partition by part)").alias("n"))
    met = laid.join(counts, F.col("part").eqNullSafe(F.col("of")) & (F.col("task") == F.col("in")))
    return met.select(*rows.columns, (F.col("before") + F.col("place") - F.col("first")).alias("rank"), "n")


def _runs(n: Column, level: int) -> Column:
    """How many nodes a part of n nodes has some levels above."""
    return F.ceil(n / F.lit(FAN_OUT ** level)).cast("long") if level else n


def rolled(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Blocks of nodes (part, rank, n, hash, payload): part, n, block, hash, kids.

    ``kids`` nest to the nodes themselves. A level of a part that has one node left is passed through.
    """
    digits = [f"d{k}" for k in range(DIGITS)]
    shifted = {d: F.pmod(F.shiftright("rank", 3 * k), F.lit(FAN_OUT)).cast("int") for k, d in enumerate(digits)}
    cur = (nodes.select("part", "n", F.shiftright("rank", 3 * DIGITS).alias("block"), *[c.alias(d) for d, c in shifted.items()],
                        "hash", *payload)
           .repartition("part", "block"))
    inner = list(payload)
    for level, digit in enumerate(digits):
        keys = ["part", "n", "block", *reversed(digits[level + 1:])]
        kids = F.sort_array(F.collect_list(F.struct(digit, "hash", *inner)))
        cur = cur.groupBy(*keys).agg(kids.alias("kids"))
        one = F.array_join("kids.hash", "")
        cur = cur.withColumn("hash", F.when(_runs(F.col("n"), level) > 1, F.sha2(one, 256)).otherwise(one))
        inner = ["kids"]
    return cur


def spread(blocks: DataFrame, above: DataFrame, carried: Sequence[str], payload: Sequence[str] = ()) -> DataFrame:
    """The nodes of blocks: part, rank, hash, path, carried and payload columns.

    ``above`` holds the path of each block (part, rank, path, carried). Both meet in one grouping; each
    level is then exploded with the hashes left and right of each node.
    """
    lower = blocks.select("part", "block", "n", "kids")
    upper = above.select("part", F.col("rank").alias("block"), "path", *carried)
    cur = lower.unionByName(upper, allowMissingColumns=True).groupBy("part", F.col("block").alias("rank")).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", *carried)])
    for level in reversed(range(DIGITS)):
        every = F.col("kids.hash")
        kids = F.transform("kids", lambda kid, i: F.struct(
            kid.alias("kid"), F.struct(F.array_join(F.slice(every, F.lit(1), i), "").alias("left"),
                                       F.array_join(F.slice(every, i + 2, F.lit(FAN_OUT)), "").alias("right")).alias("beside")))
        own = F.when(_runs(F.col("n"), level) > 1, F.array("beside")).otherwise(F.array().cast(PATH))
        cur = cur.select("part", "rank", "n", "path", *carried, F.inline(kids))
        names = ["kid.kids"] if level else ["kid.hash", *[f"kid.{p}" for p in payload]]
        cur = cur.select("part", (F.col("rank") * FAN_OUT + F.col(f"kid.d{level}")).alias("rank"), "n",
                         F.concat(own, "path").alias("path"), *carried, *names)
    return cur.drop("n")


def _rounds(nodes: DataFrame, payload: Sequence[str], label: str) -> list[DataFrame]:
    """Blocks of every round; in the last one each part is one block."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out = []
    while True:
        blocks = saved(rolled(nodes, () if out else payload), f"op13-{label}-{len(out)}")
        out.append(blocks)
        if most <= BLOCK:
            return out
        most = math.ceil(most / BLOCK)
        nodes = blocks.select("part", F.col("block").alias("rank"), _runs(F.col("n"), DIGITS).alias("n"), "hash")


def _paths(rounds: list[DataFrame], above: DataFrame, carried: Sequence[str], payload: Sequence[str]) -> DataFrame:
    for number, blocks in reversed(list(enumerate(rounds))):
        above = spread(blocks, above, carried, () if number else payload)
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, beside: digest(beside["left"], node, beside["right"]))


def manifest(docs: DataFrame, key: str = "doc_id", part: str = "lang", fields: Sequence[str] = FIELDS,
             altered: Mapping[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: key, leaf, subroot, root, path, changed_leaf.

    ``path`` holds the hashes left and right of the leaf and of each node above it, from the leaf up.
    With ``altered`` (values of fields) ``changed_leaf`` is the leaf of the row so altered, for rows
    that meet ``where``; else it is the leaf.
    """
    own = {f: F.col(f"`{f}`") for f in fields}
    leaf = leaf_hash(list(own.values()))
    other = leaf_hash([(altered or {}).get(f, c) for f, c in own.items()])
    changed = F.when(where if where is not None else F.lit(bool(altered)), other)
    leaves = docs.select(F.col(f"`{part}`").alias("part"), F.col(f"`{key}`").alias("key"), leaf.alias("hash"), changed.alias("changed"))
    payload = ("key", "changed")
    rounds = _rounds(ranked(leaves, ("key", "hash"), "leaves"), payload, "leaves")
    # the parts' roots are the leaves of one tree, of which each part's name is the payload
    subroots = rounds[-1].select(F.lit(0).alias("part"), F.col("part").alias("name"), "hash")
    tops = _rounds(ranked(subroots, ("name",), "parts"), ("name",), "parts")
    root = tops[-1].select("part", F.col("block").alias("rank"), F.array().cast(PATH).alias("path"), F.col("hash").alias("root"))
    parts = _paths(tops, root, ("root",), ("name",))
    above = parts.select(F.col("name").alias("part"), F.lit(0).cast("long").alias("rank"), "path", F.col("hash").alias("subroot"), "root")
    nodes = _paths(rounds, above, ("subroot", "root"), payload)
    return nodes.select(F.col("key").alias(key), F.col("hash").alias("leaf"), "subroot", "root", "path",
                        F.coalesce("changed", "hash").alias("changed_leaf"))


def verified(proofs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The digest of each proof, and the root that the changed leaf folds to with the original siblings."""
    beside = F.transform("path", lambda p: F.concat(p["left"], p["right"]))
    out = proofs.select(key, "leaf", "subroot", "root", F.sha2(F.array_join(beside, ""), 256).alias("proof_sha256"),
                        folded(F.col("changed_leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = {"text": lower_ascii(F.col("text"))}
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return verified(manifest(table(spark, sf_dir, "documents"), altered=lowered, where=third))


def _oracle(levels: int = 7, top_levels: int = 3) -> str:
    """DuckDB SQL of the same rows, a level after the other; for up to 8^levels rows of a lang and 8^top_levels langs."""
    def enc(c):
        return f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"

    def leaf(text):
        return f"sha256({enc('doc_id')} || {enc('source')} || {enc('lang')} || {enc('n_chars')} || {enc(text)})"
    codes = "list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)"
    bits = "list_reduce([xor(a, b)] || range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)"
    crc = f"xor(list_reduce([4294967295::bigint] || {codes}, lambda a, b: {bits}), 4294967295)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [f"l as (select doc_id, lang, {leaf('text')} as leaf, case when coalesce({crc} % 3 = 0, false) then {leaf(lowered)} end as other from documents)",
            "a0 as (select doc_id, leaf, coalesce(other, leaf) as f, '' as proof, dense_rank() over (order by lang nulls first) - 1 as g, "
            "row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as r, count(*) over (partition by lang) as n from l)",
            "n0 as (select g, r, n, leaf as h from a0)"]

    def up(k: int, also: str = "") -> list[str]:
        beside = "partition by g, r // 8 order by r rows between"
        return [f"s{k} as (select g, r, n, coalesce(string_agg(h, '') over ({beside} unbounded preceding and 1 preceding), '') as a, "
                f"coalesce(string_agg(h, '') over ({beside} 1 following and unbounded following), '') as b from n{k})",
                f"a{k + 1} as (select t.doc_id, t.leaf, {also}t.g, t.r // 8 as r, case when s.n > 1 then sha256(s.a || t.f || s.b) else t.f end as f, "
                f"t.proof || s.a || s.b as proof from a{k} t join s{k} s on t.g = s.g and t.r = s.r)",
                f"n{k + 1} as (select g, r // 8 as r, (n + 7) // 8 as n, case when n > 1 then sha256(string_agg(h, '' order by r)) "
                f"else any_value(h) end as h from n{k} group by g, r // 8, n)"]
    for k in range(levels):
        ctes += up(k)
    first = levels + 1  # the langs are the nodes now, of one part
    ctes += [f"a{first} as (select doc_id, leaf, 0 as g, g as r, f, proof, g as own from a{levels})",
             f"n{first} as (select 0 as g, g as r, count(*) over () as n, h from n{levels})",
             f"sub as (select r as own, h as subroot from n{first})"]
    for k in range(first, first + top_levels):
        ctes += up(k, "t.own, ")
    end = first + top_levels
    return (f"with {', '.join(ctes)} select doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, f as folded_root, f = h as verified "
            f"from a{end} join n{end} using (g) join sub using (own)")


ORACLE = _oracle()

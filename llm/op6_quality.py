"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover it whole (the last one ends with the text). Each
chunk's bytes are embedded, convolved with learned filters, max-pooled over the chunk and combined
into one logit; a document's probability is the logistic of the mean of its chunks' logits. Only
the text is an input. Weights are learned on the driver from a bounded sample of labelled rows
(``max_rows`` rows, least hash of doc_id first, at most ``chunks_per_row`` chunks of each, spread
over the whole text) and travel with the scoring function (a few thousand numbers).

Defined results: null text scores as empty text, empty text as one chunk of padding; repeated rows
score alike; unlabelled rows and rows with a null label are not learned from; without any labelled
row every score is the neutral 0.5. Documents with a null doc_id are never held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from llm.common import table
from llm.textnp import slices, text_bytes

CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE, DIM, FILTERS = 8, 2, 6, 24
MAX_ROWS, CHUNKS_PER_ROW = 6000, 6
PLACES = (CHUNK - WIDTH) // STRIDE + 1
THRESHOLD = 0.7

Weights = dict[str, np.ndarray]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chunk_starts(size: int) -> np.ndarray:
    """Starts of the chunks of a text of ``size`` bytes; together they cover it."""
    if size <= CHUNK:
        return np.zeros(1, np.int64)
    starts = np.arange(0, size - CHUNK, CHUNK - OVERLAP, dtype=np.int64)
    return np.append(starts, size - CHUNK)


def chunks_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(n, CHUNK) bytes; 0 pads what is past ``ends``."""
    at = starts[:, None] + np.arange(CHUNK)
    out = np.zeros(at.shape, np.uint8)
    inside = at < ends[:, None]
    out[inside] = raw[at[inside]]
    return out


def _columns(emb: np.ndarray, x: np.ndarray) -> np.ndarray:
    """(n, PLACES, WIDTH * DIM): what each place of the filters sees."""
    e = np.ascontiguousarray(emb[x])
    n, s = len(x), e.strides
    view = np.lib.stride_tricks.as_strided(e, (n, PLACES, WIDTH * DIM), (s[0], s[1] * STRIDE, s[2]))
    return view


def logits(w: Weights, x: np.ndarray) -> np.ndarray:
    seen = _columns(w["emb"], x).reshape(-1, WIDTH * DIM) @ w["filters"]
    pooled = seen.reshape(len(x), PLACES, FILTERS).max(axis=1) + w["bias"]
    return np.maximum(pooled, 0) @ w["out"] + w["out_bias"][0]


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 1500, batch: int = 64, seed: int = 3) -> Weights:
    """Adam on the logistic loss of chunks; a filter's gradient flows through its pooled place."""
    rng = np.random.default_rng(seed)
    w = {"emb": rng.normal(0, 0.5, (256, DIM)), "filters": rng.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)),
         "bias": np.zeros(FILTERS), "out": rng.normal(0, FILTERS ** -0.5, FILTERS), "out_bias": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    w["emb"][0] = 0
    if not len(x):
        return w | {"out": np.zeros(FILTERS, np.float32)}
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    chance = weight / weight.sum()
    order = rng.choice(len(x), size=(steps, batch), p=chance)
    for step, rows in enumerate(order, 1):
        xb, yb = x[rows], y[rows]
        cols = _columns(w["emb"], xb)
        seen = (cols.reshape(-1, WIDTH * DIM) @ w["filters"]).reshape(batch, PLACES, FILTERS)
        best = seen.argmax(axis=1)
        pooled = np.take_along_axis(seen, best[:, None], 1)[:, 0] + w["bias"]
        hidden = np.maximum(pooled, 0)
        d = (1 / (1 + np.exp(-np.clip(hidden @ w["out"] + w["out_bias"][0], -30, 30))) - yb) / batch
        dh = (d[:, None] * w["out"]) * (pooled > 0)
        at = cols[np.arange(batch)[:, None], best]                      # (batch, FILTERS, WIDTH * DIM)
        demb = np.zeros_like(w["emb"])
        place = best[:, :, None] * STRIDE + np.arange(WIDTH)            # bytes the pooled places saw
        np.add.at(demb, xb[np.arange(batch)[:, None, None], place],
                  (dh[:, :, None] * w["filters"].T).reshape(batch, FILTERS, WIDTH, DIM))
        demb[0] = 0
        grads = {"emb": demb, "filters": np.einsum("bfk,bf->kf", at, dh), "bias": dh.sum(0), "out": hidden.T @ d,
                 "out_bias": d.sum(keepdims=True)}
        rate = 0.01 * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v2[k] = 0.999 * v2[k] + 0.001 * g * g
            w[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return w


def _sample_chunks(batches):
    for b in slices(batches, "text"):
        raw, offsets = text_bytes(b.column("text"))
        rows, parts, shares = [], [], []
        for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
            starts = chunk_starts(int(hi - lo))
            take = starts[np.unique(np.linspace(0, len(starts) - 1, CHUNKS_PER_ROW).astype(int))]
            cut = chunks_of(raw, lo + take, np.full(len(take), hi))
            rows += [i] * len(take)
            parts += [c.tobytes() for c in cut]
            shares += [1 / len(take)] * len(take)
        yield pa.RecordBatch.from_arrays([b.column("quality").take(pa.array(rows, pa.int64())), pa.array(parts, pa.binary()),
                                          pa.array(shares, pa.float64())], names=["quality", "chunk", "share"])


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, seed: int = 3) -> Weights:
    """Weights from at most ``max_rows`` labelled documents that are not held out."""
    known = (labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"))
             .where(F.col("__id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("__id")))
             .groupBy("__id").agg(F.max("quality").alias("quality"))
             .orderBy(F.xxhash64("__id"), "__id").limit(max_rows))
    # at most max_rows pairs of an id and a bit: small enough to broadcast
    rows = (docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__id")).select("quality", "text")
            .mapInArrow(_sample_chunks, "quality int, chunk binary, share double"))
    got = rows.toArrow().sort_by([("chunk", "ascending"), ("quality", "ascending"), ("share", "ascending")])
    x = np.frombuffer(b"".join(got["chunk"].to_pylist()), np.uint8).reshape(-1, CHUNK)
    return fit(x, got["quality"].to_numpy().astype(np.float32), got["share"].to_numpy(), seed=seed)


def scorer(w: Weights, text: str = "text", keep_text: bool = False, name: str = "score", at_once: int = 256):
    """Arrow batches with a text column to the same batches with the score (without the text unless kept)."""
    def score(batches):
        for b in slices(batches, text):
            raw, offsets = text_bytes(b.column(text))
            starts = [chunk_starts(int(n)) for n in np.diff(offsets)]
            doc = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
            begin = np.concatenate([np.zeros(0, np.int64), *(lo + s for lo, s in zip(offsets[:-1], starts))])
            end = offsets[1:][doc]
            z = np.concatenate([np.zeros(0), *(logits(w, chunks_of(raw, begin[i:i + at_once], end[i:i + at_once]))
                                               for i in range(0, len(doc), at_once))])
            mean = np.bincount(doc, z, len(starts)) / np.maximum(1, np.bincount(doc, minlength=len(starts)))
            p = 1 / (1 + np.exp(-np.clip(mean, -30, 30)))
            keep = [n for n in b.schema.names if keep_text or n != text]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(p)], names=[*keep, name])
    return score


def accepted(docs: DataFrame, weights: Weights, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, with their columns as they are."""
    name = "__score"
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(scorer(weights, text, True, name), schema).where(F.col(name) >= threshold).drop(name)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = learn(docs, table(spark, sf_dir, "labels"))
    scored = docs.mapInArrow(scorer(weights), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

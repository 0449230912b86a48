"""Language-model scoring by cross-entropy difference.

Two bigram models with the same vocabulary, order and smoothing are counted over the corpus: the
target model over given documents (by default those that labels call good), the background model
over all documents. A document's score is its mean loss per word under the target model less that
under the background model (nats; lower is closer to the target). Every document is scored by the
counts of the others: its own are taken off both models, so being in the target does not help it.

Model: p(w) = c(w) / N for the background, (c(w) + MU p_background(w)) / (N + MU) for the target;
p(w | v) = (c(v w) + K p(w)) / (c(v) + K) in both. The vocabulary is every word that stands in
another document; a word outside it costs both models the same and so adds nothing. N-grams are
counted by hashed names of 40 to 64 bits.

Defined results: null or word-free texts have no words and score 0; rows that repeat a doc_id are
scored one by one and are all in the target if the id is; without target documents every score is
0; a null doc_id is never in the target.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import saved, table
from llm.exchange import ANSWER, QUESTION, Deal, answer_parts, answers, ask, chunk_of, deal
from llm.textnp import U, mix, pack_values, slices, text_bytes, unpack_values, word_names, words

MU, K = 1000.0, 5.0


def pack_counts(counts: np.ndarray) -> bytes:
    """(n, 2) counts, background and target, as two columns."""
    every = pack_values(counts[:, 0])
    return len(every).to_bytes(8, "little") + every + pack_values(counts[:, 1])


def unpack_counts(b: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(b[:8], "little")
    return np.column_stack([unpack_values(b[8:end]), unpack_values(b[end:])])


class _Grams:
    """Words of a chunk, their unigram and bigram keys, and which documents are in the target."""

    def __init__(self, left: pa.Table, right: pa.Table, bits: int):
        raw, offsets = text_bytes(left["text"])
        self.n = len(left)
        starts, ends, self.row = words(raw, offsets)
        name = word_names(raw, starts, ends)
        target = {i for r, i in zip(right["round"].to_pylist(), right["doc_id"].to_pylist()) if r == 0}
        self.target = np.fromiter((i in target for i in left["doc_id"].to_pylist()), bool, self.n)
        self.second = np.flatnonzero(self.row[1:] == self.row[:-1]) + 1
        pair = mix(mix(name[self.second - 1]) * U(5) + name[self.second])
        self.keys, self.place = np.unique(np.concatenate([name, pair]) >> U(64 - bits), return_inverse=True)
        self.of = np.concatenate([self.row, self.row[self.second]])

    def counts(self) -> np.ndarray:
        every = np.bincount(self.place, minlength=len(self.keys))
        mine = np.bincount(self.place, self.target[self.of], minlength=len(self.keys)).astype(np.int64)
        return np.column_stack([every, mine])


def _ask(sizes: Deal):
    def f(left: pa.Table, right: pa.Table) -> pa.Table:
        g = _Grams(left, right, sizes.bits)
        chunk = (left if len(left) else right)["chunk"][0].as_py()
        return ask(chunk, 1, g.keys, g.counts(), sizes.bits, sizes.buckets, pack_counts)
    return f


def _sum(group: pa.Table) -> pa.Table:
    def combine(order, number, ends, vals):
        given = np.concatenate([unpack_counts(v) for v in vals])[order]
        n = number[-1] + 1 if len(number) else 0
        out = np.empty((len(order), 2), np.int64)
        for k in range(2):  # sums of doubles are exact up to 2^53
            out[order, k] = np.bincount(number, given[:, k], n).astype(np.int64)[number]
        return [pack_counts(x) for x in np.split(out, ends[:-1])]
    return answers(group, combine)


def _score(sizes: Deal, n_target: int, n_all: int):
    def f(left: pa.Table, right: pa.Table) -> pa.Table:
        g = _Grams(left, right, sizes.bits)
        n = len(g.row)
        total = np.concatenate([np.zeros((0, 2), np.int64), *(unpack_counts(b) for b in answer_parts(right, 1))])[g.place]
        _, own, often = np.unique(g.of * np.int64(max(1, len(g.keys))) + g.place, return_inverse=True, return_counts=True)
        own = often[own]
        in_target = g.target[g.of]
        every = (total[:, 0] - own).astype(np.float64)
        target = (total[:, 1] - own * in_target).astype(np.float64)
        size = np.bincount(g.row, minlength=g.n)
        rest_all = np.maximum(n_all - size, 1)[g.row]
        rest_target = np.maximum(n_target - size * g.target, 0)[g.row]
        known = every[:n] > 0
        p_all = np.where(known, every[:n], 1) / rest_all
        p_target = (target[:n] + MU * p_all) / (rest_target + MU)
        b = g.second
        p_all2, p_target2 = p_all.copy(), p_target.copy()
        p_all2[b] = (every[n:] + K * p_all[b]) / (every[b - 1] + K)
        p_target2[b] = (target[n:] + K * p_target[b]) / (target[b - 1] + K)
        loss = [np.bincount(g.row, np.where(known, -np.log(p), 0), minlength=g.n) for p in (p_target2, p_all2)]
        if not n_target:
            loss[0] = loss[1]
        scored = np.bincount(g.row, known, minlength=g.n).astype(np.int64)
        per = np.maximum(scored, 1)
        return pa.table({"doc_id": left["doc_id"], "n_words": pa.array(size, pa.int64()), "n_scored": pa.array(scored, pa.int64()),
                         "target_loss": loss[0] / per, "background_loss": loss[1] / per, "score": (loss[0] - loss[1]) / per})
    return f


def _word_count(batches):
    for b in slices(batches, "text"):
        raw, offsets = text_bytes(b.column("text"))
        _, _, row = words(raw, offsets)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.bincount(row, minlength=len(b)), pa.int64())],
                                         names=["doc_id", "n"])


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_scored, target_loss, background_loss, score.

    target_ids has one column: the ids of the target documents.
    """
    ids = target_ids.select(F.col(f"`{target_ids.columns[0]}`").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    chunks, sizes = deal(docs, doc_id, text, keys_per_byte=0.2)
    sizes_of = chunks.select("doc_id", "text").mapInArrow(_word_count, "doc_id long, n long")
    marked = sizes_of.join(ids.withColumn("mine", F.lit(1)), "doc_id", "left")
    n_all, n_target = marked.agg(F.sum("n"), F.sum(F.col("n") * F.col("mine"))).first()
    flags = ids.select(chunk_of("doc_id", sizes).alias("chunk"), F.lit(0).alias("round"), F.lit(0).alias("bucket"),
                       F.lit(None).cast("binary").alias("vals"), "doc_id")
    by_chunk = chunks.groupBy("chunk")
    asked = by_chunk.cogroup(flags.groupBy("chunk")).applyInArrow(_ask(sizes), QUESTION)
    counted = asked.groupBy("bucket").applyInArrow(_sum, ANSWER)
    known = flags.unionByName(counted, allowMissingColumns=True)
    return by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(
        _score(sizes, n_target or 0, n_all or 0),
        "doc_id long, n_words long, n_scored long, target_loss double, background_loss double, score double")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents").select("doc_id", "text"), saved(good, "op10-target"))

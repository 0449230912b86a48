"""Questions about keys of all documents, asked and answered in packed form.

Documents are dealt into chunks of a few megabytes by their id. A chunk asks about its distinct
keys (64-bit names, sorted, packed as differences) with one value each; keys are dealt to buckets
by their high bits, so a key's questions from all chunks meet in one bucket and a key that stands in
a third of all documents still costs one entry per chunk. A bucket's task combines them and sends
each chunk an answer aligned with its question. The same text exchange serves every round of a
query: the plan reuses it, so texts are shuffled once.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.textnp import U, pack_sorted, pack_values, unpack_sorted

CHUNK_BYTES = 2 << 20
QUESTION = "bucket int, chunk int, round int, keys binary, vals binary"
ANSWER = "chunk int, round int, bucket int, vals binary"


class Deal:
    """Numbers of chunks and buckets for a corpus of so many bytes."""

    def __init__(self, total_bytes: int, keys_per_byte: float = 0.2):
        self.chunks = max(1, math.ceil(total_bytes / CHUNK_BYTES))
        self.buckets = max(1, math.ceil(total_bytes * keys_per_byte * 8 / (4 << 20)))
        self.bits = min(64, max(40, math.ceil(math.log2(total_bytes + 2)) + 18))


def deal(docs: DataFrame, doc_id: str, text: str, keys_per_byte: float = 0.2) -> tuple[DataFrame, Deal]:
    """(chunk, doc_id, text) of every row, ready to be grouped by chunk, and the numbers used."""
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    sizes = Deal(total, keys_per_byte)
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.xxhash64(F.col(f"`{text}`")))
    return docs.select(F.pmod(F.xxhash64(key), F.lit(sizes.chunks)).cast("int").alias("chunk"),
                       F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")), sizes


def chunk_of(doc_id: str, sizes: Deal):
    return F.pmod(F.xxhash64(F.col(doc_id)), F.lit(sizes.chunks)).cast("int")


def parts(keys: np.ndarray, bits: int, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys."""
    edges = np.array([(b << bits) // buckets for b in range(1, buckets)], U)
    cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    return [(b, int(cuts[b]), int(cuts[b + 1])) for b in np.flatnonzero(np.diff(cuts))]


def ask(chunk: int, round_: int, keys: np.ndarray, vals: np.ndarray | None, bits: int, buckets: int,
        pack: Callable[[np.ndarray], bytes] = pack_values) -> pa.Table:
    """The questions of a chunk about sorted distinct keys of so many bits; ``pack`` writes the values of some of them."""
    cut = parts(keys, bits, buckets)
    n = len(cut)
    return pa.table({
        "bucket": pa.array([b for b, _, _ in cut], pa.int32()), "chunk": pa.array([chunk] * n, pa.int32()),
        "round": pa.array([round_] * n, pa.int32()), "keys": pa.array([pack_sorted(keys[i:j]) for _, i, j in cut], pa.binary()),
        "vals": pa.array([b"" if vals is None else pack(vals[i:j]) for _, i, j in cut], pa.binary())})


def answers(group: pa.Table, combine: Callable[[np.ndarray, np.ndarray, np.ndarray, list], list[bytes]]) -> pa.Table:
    """One bucket. combine(order, group number of each sorted entry, owner of each entry, vals) -> bytes per question."""
    keys = [unpack_sorted(b) for b in group["keys"].to_pylist()]
    sizes = [len(k) for k in keys]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    number = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    replies = combine(order, number, ends, group["vals"].to_pylist())
    return pa.table({"chunk": group["chunk"], "round": group["round"], "bucket": group["bucket"],
                     "vals": pa.array(replies, pa.binary())})


def answer_parts(right: pa.Table, round_: int) -> list[bytes]:
    """A chunk's answers of a round in the order of its sorted keys."""
    rows = [(b, v) for r, b, v in zip(right["round"].to_pylist(), right["bucket"].to_pylist(), right["vals"].to_pylist())
            if r == round_]
    return [v for _, v in sorted(rows)]


def shared_flags(group: pa.Table) -> pa.Table:
    """Which keys other chunks asked about too: bits."""
    def combine(order, number, ends, _):
        often = np.bincount(number)[number] > 1 if len(number) else np.zeros(0, bool)
        flag = np.zeros(len(order), bool)
        flag[order] = often
        return [np.packbits(f).tobytes() for f in np.split(flag, ends[:-1])]
    return answers(group, combine)


def read_flags(blobs: list[bytes], sizes: list[int]) -> np.ndarray:
    return np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
                                                for b, n in zip(blobs, sizes, strict=True))])

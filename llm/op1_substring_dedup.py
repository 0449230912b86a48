"""Substring deduplication by recompression.

Each document's words are compressed in rounds with names that are the same everywhere: a run of
one word becomes a symbol, then neighbouring symbols whose hashed coins say left and right become
a pair symbol, twice. A symbol depends only on a few words around it, so a window of ``WINDOW``
words that stands in two places has the same symbols over its middle words in both (a run's end, a
first-round and a second-round partner can differ at each end: 1 + 1 + 2 = 4 words). Each window is
represented by the least of its middle symbols. First round over Spark: which representatives stand
in several documents. Only their windows are then named by all their words and compared across
documents, which verifies the repeats, and a window is removed from every document but the one with
the least doc_id. Equal names are taken as equal words (64 bits).

Defined results: null text has no words and is kept as it is; a text shorter than a window keeps
every word; a null doc_id comes after every other; rows that repeat a doc_id do not remove each
other's words; a document's repeats of its own windows stay.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm.common import table
from llm.exchange import ANSWER, QUESTION, Deal, answer_parts, answers, ask, deal, parts, read_flags, shared_flags
from llm.textnp import U, mix, ranges, text_bytes, unpack_values, windows, word_names, words

WINDOW = 13
EDGE = 4  # words at each end of a window whose symbols may depend on words outside it
LAST = np.iinfo(np.int64).max


def compress(names: np.ndarray, row: np.ndarray, rounds: int = 2) -> np.ndarray:
    """For every word the symbol that covers it after a round of runs and ``rounds`` of pairs."""
    if not len(names):
        return names
    same = np.concatenate([[False], (names[1:] == names[:-1]) & (row[1:] == row[:-1])])
    run = same | np.concatenate([same[1:], [False]])
    symbol = np.where(run, mix(names ^ U(0x52554E)), names)[~same]
    alone, home, at = run[~same], row[~same], np.cumsum(~same) - 1
    for level in range(1, rounds + 1):
        coin = (mix(symbol + U(level)) & U(1)).astype(bool)
        left, right = coin & ~alone, ~coin & ~alone
        first = np.concatenate([left[:-1] & right[1:] & (home[1:] == home[:-1]), [False]])
        second = np.concatenate([[False], first[:-1]])
        joined = np.concatenate([mix(mix(symbol[:-1] + U(level)) * U(3) + symbol[1:]), symbol[-1:]])
        symbol = np.where(first, joined, symbol)[~second]
        at = (np.cumsum(~second) - 1)[at]
        alone, home = alone[~second], home[~second]
    return mix(symbol)[at]


class _Chunk:
    """Words, windows and representatives of a chunk's documents."""

    def __init__(self, left: pa.Table, bits: int):
        ids = left["doc_id"].combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ids, (self.raw, self.offsets) = ids, text_bytes(left["text"])
        self.starts, self.ends, self.row = words(self.raw, self.offsets)
        self.names = word_names(self.raw, self.starts, self.ends)
        self.first = windows(self.names, self.row, WINDOW)
        symbols = compress(self.names, self.row)
        lead = np.zeros(0, U)
        if len(self.first):
            lead = symbols[self.first + EDGE]
            for j in range(EDGE + 1, WINDOW - EDGE):
                lead = np.minimum(lead, symbols[self.first + j])
        self.lead = lead >> U(64 - bits)
        self.owner = ids[self.row[self.first]] if len(self.first) else np.zeros(0, np.int64)
        order = np.argsort(self.lead, kind="stable")
        new = np.concatenate([[True], self.lead[order][1:] != self.lead[order][:-1]])[:len(order)]
        at = np.flatnonzero(new)
        self.keys = self.lead[order][at]
        self.place = np.empty(len(order), np.int64)  # of each window's key among the keys
        self.place[order] = np.cumsum(new) - 1
        owners = self.owner[order]
        self.several = (np.minimum.reduceat(owners, at) != np.maximum.reduceat(owners, at)) if len(at) else np.zeros(0, bool)

    def named(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows kept: distinct names, the least owner of each, and each window's place among them."""
        first = self.first[keep]
        if not len(first):
            return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        names, place = np.unique(ranges(self.names, first, first + WINDOW), return_inverse=True)
        least = np.full(len(names), LAST)
        np.minimum.at(least, place, self.owner[keep])
        return names, least, place


def _flags(right: pa.Table, round_: int, keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    return read_flags(answer_parts(right, round_), [j - i for _, i, j in parts(keys, bits, buckets)])


def _symbols(sizes: Deal):
    def f(left: pa.Table) -> pa.Table:
        c = _Chunk(left, sizes.bits)
        return ask(left["chunk"][0].as_py(), 1, c.keys, None, sizes.bits, sizes.buckets)
    return f


def _windows(sizes: Deal):
    def f(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return ask(0, 2, np.zeros(0, U), np.zeros(0, np.int64), 64, sizes.buckets)
        c = _Chunk(left, sizes.bits)
        shared = _flags(right, 1, c.keys, sizes.bits, sizes.buckets)
        names, least, _ = c.named(shared[c.place])
        return ask(left["chunk"][0].as_py(), 2, names, least, 64, sizes.buckets)
    return f


def _earlier(group: pa.Table) -> pa.Table:
    """Which windows stand in a document before the first one of the chunk that asks: bits."""
    def combine(order, number, ends, vals):
        owner = np.concatenate([unpack_values(v) for v in vals])
        least = np.full(number[-1] + 1 if len(number) else 0, LAST)
        np.minimum.at(least, number, owner[order])
        flag = np.zeros(len(order), bool)
        flag[order] = owner[order] > least[number]
        return [np.packbits(x).tobytes() for x in np.split(flag, ends[:-1])]
    return answers(group, combine)


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _kept(sizes: Deal, with_text: bool):
    def f(left: pa.Table, right: pa.Table) -> pa.Table:
        c = _Chunk(left, sizes.bits)
        gone = np.zeros(len(c.names) + 1, np.int64)
        if len(c.first):
            shared = _flags(right, 1, c.keys, sizes.bits, sizes.buckets)
            asked = np.flatnonzero(shared[c.place])
            names, least, place = c.named(asked)
            before = _flags(right, 2, names, 64, sizes.buckets)
            out = np.zeros(len(c.first), bool)
            out[asked] = before[place] | (least[place] < c.owner[asked])
            own = np.flatnonzero((c.several & ~shared)[c.place])  # repeats inside this chunk alone
            _, least, place = c.named(own)
            out[own] = least[place] < c.owner[own]
            np.add.at(gone, c.first[out], 1)
            np.add.at(gone, c.first[out] + WINDOW, -1)
        gone = np.cumsum(gone[:-1]) > 0
        n = len(c.ids)
        n_words = np.bincount(c.row, minlength=n)
        n_removed = np.bincount(c.row, gone, minlength=n).astype(np.int64)
        # kept words and one space behind each
        stays = ~gone
        size = (c.ends - c.starts)[stays]
        to = np.cumsum(size + 1) - (size + 1)
        total = int((size + 1).sum())
        out = np.full(total, 0x20, np.uint8)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(to, size) + within] = c.raw[np.repeat(c.starts[stays], size) + within]
        ends = np.concatenate([[0], np.cumsum(np.bincount(c.row[stays], size + 1, minlength=n).astype(np.int64))])
        buffer = out.tobytes()
        texts = [buffer[a:max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return pa.table({
            "doc_id": left["doc_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            "kept": pa.array([t.decode() for t in texts] if with_text else [None] * n, pa.string())})
    return f


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256 and (with_text) the kept words."""
    chunks, sizes = deal(docs, doc_id, text, keys_per_byte=0.1)
    by_chunk = chunks.groupBy("chunk")
    found = by_chunk.applyInArrow(_symbols(sizes), QUESTION).groupBy("bucket").applyInArrow(shared_flags, ANSWER)
    asked = by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(_windows(sizes), QUESTION)
    earlier = asked.groupBy("bucket").applyInArrow(_earlier, ANSWER)
    return by_chunk.cogroup(found.union(earlier).groupBy("chunk")).applyInArrow(_kept(sizes, with_text), RESULT)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, with_text=False).drop("kept")


_SPLIT = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ORACLE = f"""
with d as (select doc_id, {_SPLIT} as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as s
        from (select *, unnest(generate_series(1, len(w) - {WINDOW - 1})) as i from d where len(w) >= {WINDOW})),
least as (select s, min(doc_id) as m from win group by 1),
gone as (select distinct doc_id, unnest(generate_series(i, i + {WINDOW - 1})) as p
         from win join least using (s) where m < doc_id),
ws as (select doc_id, unnest(w) as word, unnest(generate_series(1, len(w))) as p from d where len(w) > 0),
kept as (select doc_id, string_agg(word, ' ' order by p) as k from ws where (doc_id, p) not in (select doc_id, p from gone) group by 1),
n as (select doc_id, count(*) as c from gone group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n.c, 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256
from d left join n using (doc_id) left join kept using (doc_id)
"""

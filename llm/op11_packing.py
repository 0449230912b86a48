"""Best-fit packing: documents as token sequences of bounded length.

A document's tokens are its tokenizer ids and an end id. Documents longer than a sequence are cut into
pieces of full length and a rest; everything else stays whole. Every task packs the pieces it reads by
bounded-space online best fit: at most ``open_bins`` sequences are open, a bitset holds their free
spaces, a piece goes where the least space remains, and when a new sequence makes one too many the
fullest closes. What is still open when a task ends is dealt into fewer groups and packed again, round
by round, until one group of bounded size is left; so only a bounded number of sequences of the whole
corpus closes early. Texts are never shuffled; only pieces of open sequences are.

Words are cut out where the tokenizer cuts too (white space, ASCII letters against signs and digits), so
each different word is encoded once and looked up afterwards; texts are read some megabytes at a time.
A tokenizer with other rules for words encodes whole texts.

Defined results: null and empty texts are the end id alone; rows that repeat a doc_id are packed each
for itself; a null doc_id stays null; an empty table has no sequences. Other columns are not read. The
order of pieces within a sequence is that of packing.
"""

from __future__ import annotations

import json
import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import saved, table
from llm.textnp import SPACES, text_bytes

CAPACITY, END_ID = 4096, 1
OPEN_BINS = 256       # open sequences of a task
FAN = 16              # tasks' open sequences that one task of the next round packs
BLOCK = 8 << 20       # bytes of text encoded at once
KEPT_WORDS = 600_000  # words a worker remembers at most
TOKENIZER = "word_bpe_49k.json"

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "sequence_id long, offset long, closed boolean"

# Kinds of bytes: others, ASCII letters, digits, signs, apostrophe, white space. The bar is an "other": it
# stands inside special tokens and cuts nothing.
_KIND = np.where((np.arange(256) > 32) & (np.arange(256) < 127), 3, 0).astype(np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[[ord("'"), ord("|")]] = 4, 0
_KIND[SPACES] = 5
#: Whether a word ends between bytes of two kinds (6 * left + right).
_CUT = np.array([a == 5 or a in (1, 2) and b in (3, 4) or a == 3 and b in (1, 2) or {a, b} == {1, 2} or a == b == 2
                 for a in range(6) for b in range(6)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: How the tokenizer writes bytes as letters: printable ones as they are, the others from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_AS_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


class BestFit:
    """Online best fit into bins of one capacity, of which at most ``most`` are open."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits = 0                          # bit f: a bin with free space f is open
        self.spaces: dict[int, list[int]] = {}  # free space -> open bins
        self.open = self.made = 0

    def _take(self, space: int) -> int:
        bins = self.spaces[space]
        number = bins.pop()
        if not bins:
            del self.spaces[space]
            self.bits ^= 1 << space
        self.open -= 1
        return number

    def add(self, size: int) -> tuple[int, int, int | None]:
        """Place an item: its bin, its offset there, and the bin that closes with it (if one does)."""
        fits = self.bits >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.made
            self.made += 1
        left = space - size
        if not left:
            return number, self.capacity - space, number
        self.spaces.setdefault(left, []).append(number)
        self.bits |= 1 << left
        self.open += 1
        closes = self._take((self.bits & -self.bits).bit_length() - 1) if self.open > self.most else None
        return number, self.capacity - space, closes


def word_starts(raw: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether a word starts at each byte; ``rows`` are offsets of texts.

    Cuts lie between two ASCII bytes where the tokenizer cuts as well: a letter or digit and a sign, a
    sign and a letter or digit (not after an apostrophe, which starts a contraction), a letter and a
    digit, two digits, and at white space. Normalising never reaches across them.
    """
    kind = _KIND[raw]
    start = np.zeros(len(raw), bool)
    start[1:] = _CUT[kind[:-1] * np.uint8(6) + kind[1:]]
    start[rows[rows < len(raw)]] = True
    return start & (kind != 5)


#: The tokenizer's rule for words that the cuts of ``word_starts`` follow (fixed value).
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Words:
    """Ids of texts by a tokenizer; each word is encoded once while it is remembered."""

    def __init__(self, tokenizer: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import tokenizers
        if "/" not in tokenizer:
            import public_tokenizers
            tokenizer = public_tokenizers.path(tokenizer)
        # on the library's module, because this one is sent anew with every task and the worker stays
        kept = tokenizers.__dict__.setdefault("_words_of_tasks", {})
        if tokenizer not in kept:
            kept[tokenizer] = {"all": tokenizers.Tokenizer.from_file(tokenizer)}
            kept[tokenizer]["by_word"] = self._by_word(kept[tokenizer]["all"])
            self._forget(kept[tokenizer])
        self.kept, self.by_word = kept[tokenizer], kept[tokenizer]["by_word"]

    @staticmethod
    def _by_word(tokenizer) -> bool:
        """Whether the tokenizer drops white space, lowers letters and cuts words by WORD_RULE."""
        spec = json.loads(tokenizer.to_str())
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        split, *rest = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        return (steps == ["NFC", "Replace", "Lowercase"] and split.get("pattern") == {"Regex": WORD_RULE}
                and split["behavior"] == "Removed" and split["invert"] and [x["type"] for x in rest] == ["ByteLevel"]
                and not rest[0]["add_prefix_space"] and all("|" in x["content"] for x in spec["added_tokens"]))

    @staticmethod
    def _forget(kept: dict) -> None:
        kept.update(number={}, ids=array("I"), ends=array("q", [0]))

    def _encode(self, word: str) -> list[int]:
        """The tokenizer's ids of one word, by its steps (several times as fast as one call for all)."""
        whole = self.kept["all"]
        if "|" in word:  # may hold a special token
            return whole.encode(word, add_special_tokens=False).ids
        low = word.lower()
        if low.isalpha() and max(low) < "\u0250":  # one run of letters that normalising only lowers
            letters = low if low.isascii() else low.encode().decode("latin-1").translate(_AS_LETTERS)
            return [t.id for t in whole.model.tokenize(letters)]
        return [t.id for part, _ in whole.pre_tokenizer.pre_tokenize_str(whole.normalizer.normalize_str(word))
                for t in whole.model.tokenize(part)]

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.kept["number"]) > KEPT_WORDS:
            self._forget(self.kept)
        number, ids, ends = (self.kept[k] for k in ("number", "ids", "ends"))
        for w in [w for w, n in zip(words, map(number.get, words)) if n is None]:
            number[w] = len(ends) - 1
            ids.extend(self._encode(w.decode()))
            ends.append(len(ids))
        return np.array(list(map(number.get, words)), np.int64)

    def ids(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that lie one after another, and where each text's ids end."""
        if not self.by_word:
            texts = [raw[lo:hi].tobytes().decode() for lo, hi in zip(offsets[:-1], offsets[1:])]
            each = [e.ids for e in self.kept["all"].encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for e in each for i in e], np.uint32), np.cumsum([len(e) for e in each])
        inside = ~SPACES[raw]
        begin = np.flatnonzero(word_starts(raw, offsets))
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        packed = raw[inside]
        low = _LOWER[packed]  # the tokenizer lowers, too
        at = np.append((np.cumsum(inside, dtype=np.int64)[begin]) - 1, len(packed))
        if (packed == ord("|")).any():  # special tokens are told by their case
            bars = np.add.reduceat(packed == ord("|"), at[:-1]) > 0
            low = np.where(np.repeat(bars, np.diff(at)), packed, low)
        words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(low)])
        coded = words.dictionary_encode()
        which = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        ends, flat = np.array(self.kept["ends"]), np.array(self.kept["ids"], np.uint32)
        size = (ends[1:] - ends[:-1])[which]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat((ends[which] - total[:-1]).astype(np.int32), size) + np.arange(total[-1], dtype=np.int32)]
        return ids, total[np.searchsorted(begin, offsets[1:])]


def _blocks(raw: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of about ``most`` bytes that end at the end of a text or after white space."""
    lo, n = 0, len(raw)
    while lo < n:
        hi = lo + most
        while hi < n:
            text = offsets[np.searchsorted(offsets, hi, "right") - 1]
            spaces = np.flatnonzero(SPACES[raw[hi - most:hi]])
            cut = max(int(text), hi - most + int(spaces[-1]) + 1 if len(spaces) else 0)
            if cut > lo:
                hi = cut
                break
            hi += most
        yield lo, min(hi, n)
        lo = hi


def fragments(column: pa.Array, words: Words, block: int = BLOCK) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(row, ids, whether the text ends with them) in order; a long text comes in several."""
    raw, offsets = text_bytes(column)
    row, n = 0, len(offsets) - 1
    # other tokenizers may join words across white space: their texts are encoded whole
    for lo, hi in _blocks(raw, offsets, block) if words.by_word else zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if lo == hi:
            continue
        last = int(np.searchsorted(offsets, hi, "left")) - 1  # the text that holds the byte before hi
        inner = np.clip(offsets[row:last + 2], lo, hi) - lo
        ids, ends = words.ids(raw[lo:hi], inner)
        begin = 0
        for end in ends.tolist():
            whole = offsets[row + 1] <= hi
            yield row, ids[begin:end], bool(whole)
            begin, row = end, row + int(whole)
    while row < n:  # empty texts at the end
        yield row, np.zeros(0, np.uint32), True
        row += 1


def pieces_of(column: pa.Array, words: Words, capacity: int, end_id: int, block: int = BLOCK):
    """(row, piece, start, ids) of every text."""
    held, piece = np.zeros(0, np.uint32), 0
    for row, ids, ends in fragments(column, words, block):
        ids = np.concatenate([held, ids, np.array([end_id] if ends else [], np.uint32)])
        whole = len(ids) // capacity * capacity
        for at in range(0, whole, capacity):
            yield row, piece, piece * capacity, ids[at:at + capacity]
            piece += 1
        held = ids[whole:]
        if ends:
            if len(held):
                yield row, piece, piece * capacity, held
            held, piece = held[:0], 0


class _Bins:
    """Rows of bins, handed out as bins close."""

    def __init__(self, capacity: int, most: int, first: int):
        self.fit, self.first = BestFit(capacity, most), first
        self.rows: dict[int, list[tuple]] = {}
        self.out: list[tuple] = []

    def add(self, size: int, row: tuple) -> None:
        number, offset, closes = self.fit.add(size)
        self.rows.setdefault(number, []).append((*row, self.first + number, offset, True))
        if closes is not None:
            self.out += self.rows.pop(closes)

    def end(self, closed: bool) -> None:
        for rows in self.rows.values():
            self.out += [(*r[:-1], closed) for r in rows]
        self.rows = {}

    def taken(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [[] for _ in schema]
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _schema(keep_ids: bool) -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                      ("ids_crc32", pa.int64()), *([("ids", pa.list_(pa.int32()))] if keep_ids else []),
                      ("sequence_id", pa.int64()), ("offset", pa.int64()), ("closed", pa.bool_())])


def _first(round_: int, group: int) -> int:
    """The first sequence number of a task or group of a round; each has 2^32 of them."""
    return (round_ << 58) + (group << 32)


def _read_and_pack(tokenizer: str, capacity: int, end_id: int, open_bins: int, keep_ids: bool):
    schema = _schema(keep_ids)

    def pack(batches):
        words, bins = Words(tokenizer), _Bins(capacity, open_bins, _first(0, TaskContext.get().partitionId()))
        for b in batches:
            names = b.column("doc_id").to_pylist()
            for row, piece, start, ids in pieces_of(b.column("text"), words, capacity, end_id):
                own = (ids.view(np.int32),) if keep_ids else ()
                bins.add(len(ids), (names[row], piece, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")), *own))
            yield bins.taken(schema)
        bins.end(False)
        yield bins.taken(schema)
    return pack


def _pack_again(capacity: int, open_bins: int, round_: int, last: bool, keep_ids: bool):
    schema = _schema(keep_ids)

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        columns = [group[f.name].to_pylist() for f in schema][:-3]
        bins = _Bins(capacity, open_bins, _first(round_, key[0].as_py()))
        for row in zip(*columns):
            bins.add(row[3], row)
        bins.end(last)
        return pa.Table.from_batches([bins.taken(schema)])
    return pack


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID,
         open_bins: int = OPEN_BINS, keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    ``tokenizer`` is a path, or a name that ``public_tokenizers`` knows where the tasks run.
    """
    ddl = f"{PIECE}, {'ids array<int>, ' if keep_ids else ''}{PLACED}"
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    now = saved(rows.mapInArrow(_read_and_pack(tokenizer, capacity, end_id, open_bins, keep_ids), ddl), "op11-pieces")
    done, round_ = now.where("closed"), 0
    while True:
        left = now.where("not closed")
        tokens = left.agg(F.sum("length")).first()[0] or 0
        if not tokens:
            return done.drop("closed")
        round_ += 1
        groups = math.ceil(tokens / (FAN * open_bins * capacity))
        dealt = left.groupBy(F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("group"))
        now = saved(dealt.applyInArrow(_pack_again(capacity, open_bins, round_, groups == 1, keep_ids), ddl), f"op11-round{round_}")
        done = done.unionByName(now.where("closed"))


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences of pieces packed with their ids: sequence_id, length, doc_ids, ids. A group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
            .select("sequence_id", "length", F.col("parts.doc_id").alias("doc_ids"), F.flatten("parts.ids").alias("ids")))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

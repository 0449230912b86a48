"""Vectorised words, hashes and packed number lists for Arrow batches of texts.

Words are found in the UTF-8 bytes of many texts at once. A word's name is a polynomial of its
bytes modulo 2^64 with a random number per byte value, mixed; a sequence of words is named by a
polynomial of their names in the same way, so equal sequences have equal names everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2 ** 64, 256, dtype=U)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2 ** 64)
_POWERS: dict[int, np.ndarray] = {}

#: Bytes that end a word: space and \t \n \v \f \r.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, U)
        have[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(have)
    return have[:n]


def ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A name for each of values[start:end], the same wherever the same values stand."""
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * _powers(_BASE, len(values)), out=total[1:])
    return mix((total[ends] - total[starts]) * _powers(_INVERSE, len(values) + 1)[starts] + (ends - starts).astype(U))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column's rows one after another, and each row's offset (null as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.cast(pa.large_string()).combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, column: str, most: int = 4 << 20):
    """The batches in pieces of whole rows of about so many bytes of text (a longer text is a piece of its own)."""
    for b in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0), np.int64)
        piece = np.cumsum(size) // most
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(b)]):
            if hi > lo:
                yield b.slice(lo, hi - lo)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z in UTF-8 bytes."""
    return raw + np.where((raw >= 65) & (raw <= 90), 32, 0).astype(np.uint8)


def words(raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    inside = ~breaks[raw]
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[offsets < len(raw)]] = False
    after[offsets[offsets > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_names(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 4 << 20) -> np.ndarray:
    """Names of words, some million bytes at a time: what is held per byte does not grow with a long text."""
    cuts = np.flatnonzero(np.diff(starts // block)) + 1
    out = [np.zeros(0, U)]
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)]):
        if hi > lo:
            a, b = int(starts[lo]), int(ends[hi - 1])
            out.append(ranges(_BYTE[raw[a:b]], starts[lo:hi] - a, ends[lo:hi] - a))
    return np.concatenate(out)


def windows(names: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """First words of the windows of k words of one row."""
    n = len(names) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(row[:n] == row[k - 1:])


def _planes(x: np.ndarray) -> bytes:
    """Unsigned numbers as planes of bytes, as many as the largest needs."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + np.ascontiguousarray(x.astype(U).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _read(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :b[0]] = planes.T
    return out.reshape(-1).view(U)


def pack_sorted(x: np.ndarray) -> bytes:
    """Sorted unsigned numbers, as differences."""
    return _planes(np.diff(x, prepend=U(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_read(b), dtype=U)


def pack_values(x: np.ndarray) -> bytes:
    """Signed 64-bit numbers, as distances from the least."""
    base = int(x.min()) if len(x) else 0
    return base.to_bytes(8, "little", signed=True) + _planes(x.astype(np.int64).view(U) - U(base % 2 ** 64))


def unpack_values(b: bytes) -> np.ndarray:
    base = int.from_bytes(b[:8], "little", signed=True)
    return (_read(b[8:]) + U(base % 2 ** 64)).view(np.int64)

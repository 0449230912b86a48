"""Embedding whitening: principal components of integer vectors, scaled to unit variance.

Entries become integers (floor of 256 times the entry). The fit list holds each distinct vector once;
its sums and its centred products are exact whole numbers, added up in tasks and then by Spark, one
matrix entry a row, so the driver gets one covariance matrix per vector length and no vectors. Products
are taken around the nearest whole number to the mean and corrected by the exact rest.

Eigenvectors come from float32 and are then corrected by Ogita-Aishima iterations: only matrix products,
first in float64, then in extended precision. Where eigenvalues lie closer than the iteration can tell
apart, the cluster's own small matrix, taken relative to its centre, is solved and rotates its vectors.

Defined results: vectors that are null or hold null or non-finite entries have no rows; nor do empty
vectors, which have no components. Vectors of each length are a fit of their own. Equal vectors count
once in the fit and get equal results; a null vec_id stays null. Entries beyond 2^55 become the largest
long. A component without variance (fewer distinct vectors than components) has a null ``whitened`` and
takes no part in ``identity_error``, which is null if there is no other; ``explained`` is null if nothing
varies. Extra columns are not read. ``deviation`` is a decimal, null beyond 38 digits; the query's long
is null where it does not fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import saved, table

SCALE = 256
COMPONENTS = 4
LIMB = 56   # bits of the lower parts of a sum that travels as three longs
ROWS = 4096  # vectors multiplied at once


class Model(NamedTuple):
    """A fit of vectors of one length."""
    n: int
    sums: list[int]           # S
    centre: np.ndarray        # nearest whole numbers to S / n
    vectors: np.ndarray       # unit eigenvectors, a column each
    values: np.ndarray        # eigenvalues, falling
    trace: float
    error: float | None = None

    def rest(self) -> list[int]:
        """S - n * centre, exactly."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Whitened components; not a number where there is no variance."""
        y = _less(x, self.centre).astype(np.float64) - np.array([r / self.n for r in self.rest()])
        with np.errstate(divide="ignore", invalid="ignore"):
            return y @ self.vectors / np.where(self.values > 0, np.sqrt(np.abs(self.values)), np.nan)


def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x) of the usable rows."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                          F.transform(F.col(f"`{embedding}`"), lambda c: c.cast("double")).alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long"))
    return rows.where(~F.coalesce(bad, F.lit(True))).select("vec_id", x.alias("x"))


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of list<int64>, some thousand rows at a time."""
    sizes = np.asarray(column.value_lengths())
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = column.flatten().to_numpy()
    for dim in np.unique(sizes[sizes > 0]):
        every = np.flatnonzero(sizes == dim)
        for rows in np.split(every, range(ROWS, len(every), ROWS)):
            yield int(dim), rows, flat[starts[rows][:, None] + np.arange(dim)]


def _most(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _less(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """x - centre, exactly (Python's whole numbers where longs do not suffice)."""
    if _most(x) + _most(centre) < 1 << 62:
        return x - centre
    return x.astype(object) - centre.astype(object)


def _products(z: np.ndarray) -> np.ndarray:
    """z'z of whole numbers, exactly, as Python's whole numbers."""
    if len(z) * _most(z) ** 2 < 1 << 53:
        return (z.astype(np.float64).T @ z.astype(np.float64)).astype(np.int64).astype(object)
    z = z.astype(object)
    return z.T @ z


def _limbs(v: np.ndarray) -> tuple[list[int], ...]:
    low = (1 << LIMB) - 1
    return [int(a) >> 2 * LIMB for a in v], [int(a) >> LIMB & low for a in v], [int(a) & low for a in v]


def _emit(sums: dict[int, tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """One row per vector length and matrix row."""
    rows = [(dim, n, i, *_limbs(m[i])) for dim, (n, m) in sums.items() for i in range(len(m))]
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.list_(pa.int64())] * 3]
    columns = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["dim", "n", "i", "hi", "mid", "lo"])


def _totals(fit: DataFrame, centres: dict[int, np.ndarray] | None) -> dict[int, tuple[int, np.ndarray]]:
    """Per vector length, how many vectors, and their sums or (with centres) their centred products."""
    def add(batches):
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for b in batches:
            for dim, rows, x in _by_length(b.column("x")):
                if centres is not None:
                    part = _products(_less(x, centres[dim]))
                else:
                    part = (x if len(x) * _most(x) < 1 << 62 else x.astype(object)).sum(axis=0).astype(object)[None]
                n, m = sums.get(dim, (0, 0))
                sums[dim] = n + len(rows), m + part
        yield _emit(sums)
    parts = fit.mapInArrow(add, "dim int, n long, i int, hi array<long>, mid array<long>, lo array<long>")
    each = parts.select("dim", "n", "i", F.posexplode(F.arrays_zip("hi", "mid", "lo")).alias("j", "v"))
    # a vector and a matrix per length: bounded by the lengths, not by the rows
    limbs = [F.sum(F.col(f"v.{c}").cast("decimal(20,0)")).alias(c) for c in ("hi", "mid", "lo")]
    got = each.groupBy("dim", "i", "j").agg(F.sum("n").alias("n"), *limbs).toArrow()
    out: dict[int, tuple[int, np.ndarray]] = {}
    for dim, i, j, n, *v in zip(*(got[c].to_pylist() for c in ("dim", "i", "j", "n", "hi", "mid", "lo"))):
        if dim not in out:
            out[dim] = n, np.zeros((dim if centres is not None else 1, dim), object)
        out[dim][1][i, j] = sum(int(part) << shift * LIMB for part, shift in zip(v, (2, 1, 0)))
    return out


def covariance(n: int, products: np.ndarray, rest: list[int]) -> np.ndarray:
    """(n * products - rest rest') / n^2 of whole numbers, rounded once, to extended precision."""
    exact = n * products - np.outer(np.array(rest, object), np.array(rest, object))
    out = np.zeros(exact.shape, np.longdouble)
    for place, a in np.ndenumerate(exact):
        high = a / (n * n)
        out[place] = np.longdouble(high) + np.longdouble(float(Fraction(a, n * n) - Fraction(high)))
    return out


def _norm(m: np.ndarray) -> float:
    return float(np.linalg.norm(m.astype(np.float64), 2))


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Groups of eigenvalues of which neighbours lie within ``width``."""
    order = np.argsort(values)
    gaps = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [g for g in np.split(order, gaps) if len(g) > 1]


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima iteration: better eigenvectors, the eigenvalues, and how far it went.

    Vectors within a cluster are corrected for orthogonality only; then the cluster's matrix relative to
    its centre, which holds the differences that the whole matrix hides, is solved.
    """
    eye = np.eye(len(a), dtype=a.dtype)
    r = eye - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    width = 2 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > width
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    x = x + x @ e
    moved = float(np.abs(e).max())
    noise = len(a) * float(np.finfo(a.dtype).eps) * _norm(a)
    for group in _clusters(values, width):
        q = x[:, group]
        q = q + q @ (np.eye(len(group), dtype=a.dtype) - q.T @ q) / 2
        centre = values[group].mean()
        own = q.T @ (a @ q - centre * q)
        own = (own + own.T) / 2
        size = float(np.abs(own - np.diag(np.diag(own))).max())
        if size > noise:
            q = q @ np.linalg.eigh((own / np.abs(own).max()).astype(np.float64))[1].astype(a.dtype)
            moved = max(moved, size / _norm(a))
        x[:, group] = q
    return x, values, moved


def eigen(v: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, to double precision."""
    scale = np.abs(v).max()
    if not scale:
        return np.zeros(len(v)), np.eye(len(v))
    a = v / scale
    x = np.linalg.eigh(a.astype(np.float32))[1]
    for kind in (np.float64, np.longdouble):
        x, last = x.astype(kind), np.inf
        for _ in range(rounds):
            x, values, moved = refine(a.astype(kind), x)
            if moved <= 4 * np.finfo(kind).eps * len(v) or moved > last / 2 and moved < 1e-10:
                break
            last = moved
    for _ in range(2):  # what is left of vectors of nearly equal eigenvalues not being orthogonal
        x = x + x @ (np.eye(len(a), dtype=a.dtype) - x.T @ x) / 2
    values = (x * (a @ x)).sum(axis=0) * scale
    order = np.argsort(-values, kind="stable")
    return values[order].astype(np.float64), x[:, order].astype(np.float64)


def _model(n: int, sums: np.ndarray, centre: np.ndarray, products: np.ndarray, components: int) -> Model:
    sums = [int(s) for s in sums[0]]
    v = covariance(n, products, [s - n * int(c) for s, c in zip(sums, centre)])
    values, vectors = eigen(v)
    values = np.where(values > len(v) * np.finfo(np.float64).eps * values[0], values, 0)
    return Model(n, sums, centre, vectors[:, :components], values[:components], float(np.trace(v)))


def _identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float | None]:
    """Largest entry of the fit list's whitened covariance less the identity, per vector length."""
    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for dim, _, x in _by_length(b.column("x")):
                w = np.column_stack([models[dim].whiten(x), np.ones(len(x))])  # the ones give the means
                sums[dim] = sums.get(dim, 0) + w.T @ w
        rows = [(dim, i, j, s[i, j]) for dim, s in sums.items() for i, j in np.ndindex(s.shape)]
        yield pa.RecordBatch.from_pylist([dict(zip(("dim", "i", "j", "v"), r)) for r in rows],
                                         pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())]))
    got = fit.mapInArrow(add, "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect()
    out: dict[int, float | None] = {}
    for dim, m in models.items():
        k = len(m.values)
        s = np.zeros((k + 1, k + 1))
        for r in got:
            if r["dim"] == dim:
                s[r["i"], r["j"]] = r["v"]
        mean = s[k, :k] / m.n
        error = np.abs(s[:k, :k] / m.n - np.outer(mean, mean) - np.eye(k))[m.values > 0][:, m.values > 0]
        out[dim] = float(error.max()) if error.size else None
    return out


def fitted(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model per vector length from a table of distinct vectors ``x``."""
    sums = _totals(fit, None)
    centres = {dim: np.array([(2 * int(s) + n) // (2 * n) for s in m[0]], np.int64) for dim, (n, m) in sums.items()}
    products = _totals(fit, centres)
    models = {dim: _model(n, m, centres[dim], products[dim][1], components) for dim, (n, m) in sums.items()}
    errors = _identity_errors(fit, models)
    return {dim: m._replace(error=errors[dim]) for dim, m in models.items()}


def deviations(x: np.ndarray, m: Model) -> pa.Array:
    """Sum over dimensions of (n * x - S)^2, exactly: n^2 z'z - 2 n z'r + r'r with z = x - centre, r = S - n * centre."""
    z, r = _less(x, m.centre), m.rest()
    far = _most(z) * max(1, *map(abs, r), _most(z)) * len(r) >= 1 << 62
    z, rest = (z.astype(object), np.array(r, object)) if far else (z, np.array(r, np.int64))
    squares, mixed, own = (z * z).sum(axis=1), z @ rest, sum(a * a for a in r)
    # the result and its parts wrap alike in 64 bits, so its bound alone counts
    if not far and len(r) * (m.n * _most(z) + max(map(abs, r))) ** 2 < 1 << 62:
        return pa.array(squares * (m.n * m.n) - mixed * (2 * m.n) + own, pa.int64()).cast(pa.decimal128(38, 0))
    exact = [m.n * m.n * int(a) - 2 * m.n * int(b) + own for a, b in zip(squares, mixed)]
    return pa.array([None if d >= 10 ** 38 else d for d in exact], pa.decimal128(38, 0))


def _whitened(models: dict[int, Model]):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.float64(), pa.float64(), pa.float64()]

    def out(batches):
        for b in batches:
            for dim, rows, x in _by_length(b.column("x")):
                m, vec_id = models[dim], b.column("vec_id").take(pa.array(rows))
                w, deviation = m.whiten(x), deviations(x, m)
                for k, value in enumerate(m.values):
                    same = [pa.array([v] * len(rows), t) for v, t in (
                        (k + 1, kinds[1]), (m.n, kinds[2]), (value / m.trace if m.trace else None, kinds[5]), (m.error, kinds[6]))]
                    one = pa.array(np.ascontiguousarray(w[:, k]), mask=np.isnan(w[:, k]))
                    yield pa.RecordBatch.from_arrays([vec_id, same[0], same[1], deviation, one, same[2], same[3]], names=names)
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = integers(vectors, vec_id, embedding)
    models = fitted(saved(rows.select("x").distinct(), "op12-fit"), components)
    return rows.mapInArrow(_whitened(models), "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
                                              "explained double, identity_error double")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))

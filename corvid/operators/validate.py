"""Quantity columns on tables: parse with a reason (B13), compare across
notations (B12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import FractionalType, IntegralType, StringType, DecimalType

from corvid.functions import quantity as q
from corvid.operators.aggregate import col_of
from corvid.sources.rejects import write_split

_OPS = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
}


def _parse(df: DataFrame, col: str, parser: str) -> q.Parse:
    """Pick the parse for the column's type, as the reference does per value:
    memory parsers take text only; the CPU parsers also take numbers."""
    if parser not in q.PARSERS:
        raise ValueError(f"unknown parser {parser!r}; one of {sorted(q.PARSERS)}")
    dtype = df.schema[col].dataType
    c = col_of(df, col)
    if isinstance(dtype, StringType):
        return q.PARSERS[parser](c)
    if parser == "cpu_k8s" and isinstance(dtype, (IntegralType, FractionalType)) \
            and not isinstance(dtype, DecimalType):
        return q.number_parse(c, 1000, integral=isinstance(dtype, IntegralType))
    if parser == "cpu_jvm" and isinstance(dtype, IntegralType):
        return q.number_parse(c, 1000, integral=True)
    raise TypeError(f"column {col!r} of type {dtype.simpleString()} cannot be parsed by {parser}")


def with_parsed(df: DataFrame, col: str, parser: str, value: str | None = None,
                reason: str | None = None) -> DataFrame:
    """Add the canonical integer (``<col>_value``) and the rejection reason
    (``<col>_reason``, null when valid). Narrow operators only, no shuffle.

    Each regex stage is its own projection, so each pattern runs once per
    row, and the results come out of a one-row generator: a filter on them
    stays above it instead of being pushed down with the whole parse inlined
    into the predicate (which re-ran every pattern per condition).
    """
    p = _parse(df, col, parser)
    keep = df.columns

    def ref(name: str) -> Column:
        return F.col(f"`__{col}_{name}`")

    for stage in p.stages():
        df = df.withColumns({f"__{col}_{k}": (v(ref) if callable(v) else v) for k, v in stage.items()})
    v, r = p.finish(ref)
    result = F.struct(v.alias(value or f"{col}_value"), r.alias(reason or f"{col}_reason"))
    return df.select(*[col_of(df, k) for k in keep], F.inline(F.array(result)))


def split_valid(df: DataFrame, col: str, parser: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``. Good rows carry ``<col>_value``; bad rows carry
    ``<col>_reason`` (``type``, ``pattern``, ``range``, ``not_positive``).

    With ``strict`` a bad value fails the job with its reason, as the
    reference's per-value exception would. Both outputs share one parse plan;
    cache ``df`` first if both are consumed by separate actions.
    """
    value, reason = f"{col}_value", f"{col}_reason"
    parsed = with_parsed(df, col, parser, value, reason)
    if strict:
        # every row passes through this filter, so the first bad one fails the job
        parsed = parsed.where(F.when(col_of(parsed, reason).isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"invalid {parser} quantity in {col}: "),
                                   col_of(parsed, reason))).cast("boolean")))
    good = parsed.where(col_of(parsed, reason).isNull()).drop(reason)
    bad = parsed.where(col_of(parsed, reason).isNotNull()).drop(value)
    return good, bad


def write_valid(df: DataFrame, col: str, parser: str, good_dst: str, bad_dst: str) -> tuple[DataFrame, DataFrame]:
    """B13 stored: both sides of :func:`split_valid`, from one parse and one write; returns them as read back."""
    value, reason = f"{col}_value", f"{col}_reason"
    parsed = with_parsed(df, col, parser, value, reason)
    write_split(parsed, col_of(parsed, reason).isNotNull(), good_dst, bad_dst)
    spark = df.sparkSession
    return spark.read.parquet(good_dst).drop(reason), spark.read.parquet(bad_dst).drop(value)


def _bound(text: str, parser: str) -> Column:
    """A literal quantity, parsed by the same expression and constant-folded;
    an invalid literal fails the job."""
    lit_value, lit_reason = q.PARSERS[parser](F.lit(text)).finish(
        lambda name: q.PARSERS[parser](F.lit(text)).parts[name])
    return F.when(lit_reason.isNull(), lit_value).otherwise(
        F.raise_error(F.lit(f"invalid {parser} quantity literal: {text!r}")).cast("int"))


def where_quantity(df: DataFrame, col: str, op: str, text: str, parser: str,
                   also: list[tuple[str, str]] | tuple = ()) -> DataFrame:
    """Keep rows whose quantity compares with ``text`` (any notation of
    the same grammar) by ``op``, and with every further ``(op, text)`` in
    ``also`` - one parse of the column for all of them. Rows whose own value
    is invalid never match."""
    conditions = [(op, text), *also]
    for o, _ in conditions:
        if o not in _OPS:
            raise ValueError(f"unsupported comparison {o!r}")
    value, reason = f"__{col}_cmp_value", f"__{col}_cmp_reason"
    parsed = with_parsed(df, col, parser, value, reason)
    keep = None
    for o, t in conditions:
        c = _OPS[o](col_of(parsed, value), _bound(t, parser))
        keep = c if keep is None else (keep & c)
    return parsed.where(keep).drop(value, reason)


def sort_by_quantity(df: DataFrame, col: str, parser: str, ascending: bool = True, then: list[str] | tuple = ()) -> DataFrame:
    """Order rows by their quantity whatever the notation (invalid
    values last), by the canonical integer; ties by the columns in ``then``."""
    value = f"__{col}_sort_value"
    parsed = with_parsed(df, col, parser, value, f"__{col}_sort_reason")
    order = col_of(parsed, value).asc_nulls_last() if ascending else col_of(parsed, value).desc_nulls_last()
    return parsed.orderBy(order, *[col_of(parsed, c) for c in then]).drop(value, f"__{col}_sort_reason")


def quantity_range(df: DataFrame, keys: list[str], col: str, parser: str) -> DataFrame:
    """Smallest and largest valid quantity per key (canonical integers),
    with how many values were valid. A partial + final hash aggregate."""
    value = f"{col}_value"
    parsed = with_parsed(df, col, parser, value, f"{col}_reason")
    v = col_of(parsed, value)
    return parsed.groupBy(*[col_of(parsed, k) for k in keys]).agg(
        F.min(v).alias(f"min_{col}"), F.max(v).alias(f"max_{col}"), F.count(v).alias(f"n_valid_{col}"))

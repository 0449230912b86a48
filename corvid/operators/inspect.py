"""Looking at a table: column profile (A06) and ordered preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegralType, NumericType, StringType,
                               TimestampNTZType, TimestampType)

_TEXT_ORDERED = (StringType, DateType, TimestampType, TimestampNTZType, BooleanType)


def profile(df: DataFrame) -> DataFrame:
    """One row per column - position, type, rows, nulls, min and max - in
    one pass over the table (a single global aggregate, partial per task).

    Numeric min/max are reported as doubles (``min_num``/``max_num``), and
    those of whole numbers and decimals, which a double may not hold, exactly
    as text too; text, date, timestamp and boolean min/max as text
    (``min_text``/``max_text``); other types get nulls.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"__n{i}"))
        if isinstance(f.dataType, NumericType) or isinstance(f.dataType, _TEXT_ORDERED):
            aggs += [F.min(c).alias(f"__lo{i}"), F.max(c).alias(f"__hi{i}")]
    one = df.agg(*aggs)
    entries = []
    for i, f in enumerate(df.schema.fields):
        lo = F.col(f"__lo{i}") if f"__lo{i}" in one.columns else F.lit(None)
        hi = F.col(f"__hi{i}") if f"__hi{i}" in one.columns else F.lit(None)
        numeric = isinstance(f.dataType, NumericType)
        texty = isinstance(f.dataType, (*_TEXT_ORDERED, IntegralType, DecimalType))
        entries.append(F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i).alias("ordinal"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("n_rows"),
            (F.col("__rows") - F.col(f"__n{i}")).alias("n_nulls"),
            (lo.cast("double") if numeric else F.lit(None).cast("double")).alias("min_num"),
            (hi.cast("double") if numeric else F.lit(None).cast("double")).alias("max_num"),
            (lo.cast("string") if texty else F.lit(None).cast("string")).alias("min_text"),
            (hi.cast("string") if texty else F.lit(None).cast("string")).alias("max_text"),
        ))
    return one.select(F.inline(F.array(*entries)))


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-k: each task keeps
    only its own ``n`` best rows before the final merge)."""
    return df.orderBy(*order).limit(n)

"""Grouping and ordering: group mean (A08), global sort (A09) and quantity
totals (B10). All are partial + final hash aggregates, so a hot key is
collapsed inside each map task before anything is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def col_of(df: DataFrame, name: str | Column) -> Column:
    """A column by name; names of top-level columns are taken literally (a
    dot in them is not a field access)."""
    if isinstance(name, Column):
        return name
    return F.col(f"`{name}`") if name in df.columns else F.col(name)


def group_avg(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean of each numeric column per key. Nulls are skipped, a null key
    is its own group, an all-null group gives null. Result columns are named
    ``avg(<col>)``."""
    return df.groupBy(*[col_of(df, k) for k in keys]).agg(
        *[F.avg(col_of(df, c)).alias(f"avg({c})") for c in cols])


def sort_by(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Global ascending sort, nulls first (range exchange + sort)."""
    return df.sort(*[col_of(df, c).asc_nulls_first() if isinstance(c, str) else c for c in cols])


def sum_quantity(df: DataFrame, keys: Sequence[str], col: str, name: str | None = None,
                 count_name: str | None = None) -> DataFrame:
    """Total of a canonical quantity per key.

    Summed as ``decimal(38,0)``: exact, and a total of many large values cannot
    overflow as a ``bigint`` would. Null quantities are skipped; a group with
    no quantity totals to null. ``count_name`` adds the number of quantities
    summed, in the same aggregate.
    """
    name = name or f"total_{col}"
    aggs = [F.sum(col_of(df, col).cast("decimal(38,0)")).alias(name)]
    if count_name:
        aggs.append(F.count(col_of(df, col)).alias(count_name))
    return df.groupBy(*[col_of(df, k) for k in keys]).agg(*aggs)

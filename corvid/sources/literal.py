"""Literal rows.

Literal rows are driver-side by nature; they are meant for small dimension
tables and test inputs, never for fact data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows(spark: SparkSession, data: Iterable[Sequence[Any] | dict[str, Any]],
         schema: StructType | str | None = None) -> DataFrame:
    """Rows given in Python, with a declared schema (A01) or an inferred one.

    Inferred tuples name their columns ``_1, _2, ...``; dicts become columns in
    sorted key order. Prefer a declared schema: inference costs a pass over the
    rows and widens integers to ``bigint``.
    """
    data = list(data)
    if schema is None:
        return spark.createDataFrame(data)
    return spark.createDataFrame(data, schema=schema)

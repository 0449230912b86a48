"""Profile, preview, group mean and sort (A06-A09) on edge cases."""

from __future__ import annotations

import datetime as dt

from corvid.operators.aggregate import group_avg, sort_by
from corvid.operators.inspect import preview, profile


def test_profile_mixed_types(spark):
    df = spark.createDataFrame(
        [(1, "b", 2.5, dt.date(2024, 1, 2), True, [1]), (None, "a", None, None, False, None),
         (3, None, -1.0, dt.date(2023, 5, 6), None, [2, 3])],
        "i int, s string, d double, day date, flag boolean, arr array<int>")
    rows = {r.column_name: r for r in profile(df).collect()}
    assert [rows[c].ordinal for c in df.columns] == list(range(6))
    assert rows["i"].data_type == "int" and rows["i"].n_rows == 3 and rows["i"].n_nulls == 1
    assert (rows["i"].min_num, rows["i"].max_num) == (1.0, 3.0)
    assert (rows["s"].min_text, rows["s"].max_text, rows["s"].n_nulls) == ("a", "b", 1)
    assert (rows["d"].min_num, rows["d"].max_num) == (-1.0, 2.5)
    assert (rows["day"].min_text, rows["day"].max_text) == ("2023-05-06", "2024-01-02")
    assert (rows["flag"].min_text, rows["flag"].max_text) == ("false", "true")
    assert rows["arr"].min_text is None and rows["arr"].n_nulls == 1


def test_preview_is_ordered_and_bounded(spark):
    df = spark.range(100).selectExpr("id", "100 - id as r")
    got = [r.id for r in preview(df, ["r"], 5).collect()]
    assert got == [99, 98, 97, 96, 95]


def test_group_avg_null_semantics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 4.0), (None, 6.0), ("b", None)],
                               "k string, v double")
    got = {r.k: r["avg(v)"] for r in group_avg(df, ["k"], ["v"]).collect()}
    assert got == {"a": 1.0, None: 5.0, "b": None}


def test_sort_nulls_first_ascending(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert [r.x for r in sort_by(df, ["x"]).collect()] == [None, 1, 2]


def test_profile_awkward_column_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "`a.b` int, `c d` string")
    rows = {r.column_name: r for r in profile(df).collect()}
    assert rows["a.b"].max_num == 2.0 and rows["c d"].n_nulls == 1


def test_aggregates_take_dotted_names(spark):
    from corvid.operators.aggregate import sum_quantity
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0)], "`k.k` string, `v.v` double")
    assert [tuple(r) for r in group_avg(df, ["k.k"], ["v.v"]).collect()] == [("x", 2.0)]
    assert group_avg(df, ["k.k"], ["v.v"]).columns == ["k.k", "avg(v.v)"]
    assert [r["v.v"] for r in sort_by(df, ["v.v"]).collect()] == [1.0, 3.0]
    assert sum_quantity(df.withColumn("v.v", df["`v.v`"].cast("long")), ["k.k"], "v.v", "t").first().t == 4

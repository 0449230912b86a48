"""Quantity grammars and arithmetic (B01-B13), restating the reference's
unit cases as table-driven Spark tests, plus property tests against a plain
restatement of the grammar."""

from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corvid.functions import quantity as q
from corvid.operators.aggregate import sum_quantity
from corvid.operators.validate import split_valid, where_quantity, with_parsed
from tests.conftest import one_col


def parse(spark, fn, values):
    df = one_col(spark, values)
    return [(r.v, r.r) for r in df.select(fn("s").alias("x")).select("x.value", "x.reason")
            .toDF("v", "r").collect()]


def test_memory_k8s_values_and_errors(spark):
    got = parse(spark, q.memory_k8s, ["100Mi", "1Gi", "512", "invalid", None, "0Mi", "0.5", "1.5",
                                      "8Ei", "3000Ei", "1K", "1e3", "-1Mi", " 1Mi", "1Mi\n", ".5Ki", "1."])
    assert got == [(104857600, None), (1073741824, None), (512, None), (None, "pattern"), (None, "type"),
                   (None, "not_positive"), (None, "not_positive"), (1, None), (2 ** 63, None),
                   (3000 * 2 ** 60, None), (None, "pattern"), (None, "pattern"), (None, "pattern"),
                   (None, "pattern"), (1048576, None), (512, None), (1, None)]


def test_memory_jvm_values_and_errors(spark):
    got = parse(spark, q.memory_jvm, ["100m", "2g", "1t", "invalid", "1.5g", "2G", "0", "512",
                                      "99999999999999999999", "9007199254740993", "9" * 39, "9" * 38 + "k"])
    assert got == [(104857600, None), (2147483648, None), (1099511627776, None), (None, "pattern"),
                   (None, "pattern"), (None, "pattern"), (None, "not_positive"), (512, None),
                   (99999999999999999999, None), (9007199254740993, None), (None, "range"), (None, "range")]


def test_cpu_parsers(spark):
    assert parse(spark, q.cpu_k8s, ["1.5", "1500m", "1.001", "1.005", "0.5m", "1 ", "invalid", "2.5"]) == [
        (1500, None), (1500, None), (1000, None), (1004, None), (None, "not_positive"), (None, "pattern"),
        (None, "pattern"), (2500, None)]
    assert parse(spark, q.cpu_jvm, ["2", " 2 ", "+2", "-2", "1_0", "1__0", "_1", "2.5", ""]) == [
        (2000, None), (2000, None), (2000, None), (None, "not_positive"), (10000, None), (None, "pattern"),
        (None, "pattern"), (None, "pattern"), (None, "pattern")]


def test_formats(spark):
    row = spark.range(1).select(
        q.format_memory_k8s(F.lit(512), "Mi").alias("a"), q.format_memory_k8s(F.lit(512), "Gi").alias("b"),
        q.format_memory_k8s(F.lit(512), None).alias("c"),
        q.format_memory_jvm(F.lit(2147483648), "g").alias("d"), q.format_memory_jvm(F.lit(2147483648), "m").alias("e"),
        q.format_memory_jvm(F.lit(2147483648), "t").alias("f"),
        q.format_memory_k8s(F.lit(2 ** 30), "Mi").alias("g"),
        q.format_cpu_k8s(F.lit(1500)).alias("h"), q.format_cpu_jvm(F.lit(2500)).alias("i"),
        q.format_cpu_jvm(F.lit(500)).alias("j")).first()
    assert tuple(row) == ("0Mi", "0Gi", "512", "2g", "2048m", "0t", "1024Mi", "1500m", "2", "0")
    with pytest.raises(TypeError):
        q.format_memory_k8s(F.lit(1), "m")
    with pytest.raises(ValueError):
        q.format_memory_jvm(F.lit(1), None)
    with pytest.raises(ValueError):
        q.format_memory_jvm(F.lit(1), "Mi")


def test_construction_and_arithmetic(spark):
    row = spark.range(1).select(
        q.to_bytes(F.lit(512), "Mi", integral=True).alias("a"), q.to_bytes(F.lit(1024)).alias("b"),
        q.to_bytes(F.lit(0.5)).alias("c"), q.to_bytes(F.lit(-1), "Mi").alias("d"),
        q.to_bytes(F.lit(1.5)).alias("e"),
        q.to_m_cores(F.lit(2.5)).alias("f"), q.scale_cpu(F.lit(1000), 1.5).alias("g"),
        q.scale_cpu(F.lit(1000), 3).alias("h"), q.scale_memory(F.lit(512), 0.5).alias("i"),
        q.scale_memory(F.lit(1), 0.5).alias("j")).first()
    assert tuple(row) == (512 * 2 ** 20, 1024, None, None, 1, 2500, 1500, 3000, 256, None)
    with pytest.raises(TypeError):
        q.scale_cpu(F.lit(1000), "2")
    with pytest.raises(TypeError):
        q.to_bytes(F.lit(1), "invalid_unit")


def test_unit_constants():
    assert q.K8S_UNITS["Mi"] == 2 ** 20 and q.JVM_UNITS["m"] == 2 ** 20
    assert list(q.K8S_UNITS) == ["Ei", "Pi", "Ti", "Gi", "Mi", "Ki", "E", "P", "T", "G", "M", "k"]


def test_split_valid_and_type_errors(spark):
    df = spark.createDataFrame([(1, "1Gi"), (2, "bad"), (3, None), (4, "0")], "id int, m string")
    good, bad = split_valid(df, "m", "memory_k8s")
    assert [(r.id, r.m_value) for r in good.orderBy("id").collect()] == [(1, 2 ** 30)]
    assert [(r.id, r.m_reason) for r in bad.orderBy("id").collect()] == [
        (2, "pattern"), (3, "type"), (4, "not_positive")]
    nums = spark.createDataFrame([(1, 2.5), (2, 0.0)], "id int, c double")
    assert [r.c_value for r in with_parsed(nums, "c", "cpu_k8s").orderBy("id").collect()] == [2500, None]
    with pytest.raises(TypeError):
        with_parsed(nums, "c", "memory_k8s")
    with pytest.raises(Exception, match="invalid memory_k8s quantity in m"):
        split_valid(df, "m", "memory_k8s", strict=True)[0].collect()


def test_where_quantity_across_notations(spark):
    df = one_col(spark, ["1024Mi", "1Gi", "1G", "2Gi", "bad"])
    assert sorted(r.s for r in where_quantity(df, "s", "==", "1Gi", "memory_k8s").collect()) == ["1024Mi", "1Gi"]
    assert sorted(r.s for r in where_quantity(df, "s", "<", "1Gi", "memory_k8s").collect()) == ["1G"]
    with pytest.raises(Exception, match="invalid"):
        where_quantity(df, "s", "<", "1 Gi", "memory_k8s").collect()


def test_sum_quantity_is_exact(spark):
    df = spark.createDataFrame([("a", 2 ** 62), ("a", 2 ** 62), ("a", 2 ** 62), ("b", None)], "k string, b long")
    got = {r.k: r.total for r in sum_quantity(df, ["k"], "b", "total").collect()}
    assert got == {"a": 3 * 2 ** 62, "b": None}


def test_large_amounts_are_exact(spark):
    values = ["8Ei", "1Mi", "123456789.75Ei", "9007199254740993Ki", "99999999999999999999P", "9" * 60, "8191Ei"]
    got = parse(spark, q.memory_k8s, values)
    assert [v for v, _ in got] == [plain_memory_k8s(v) for v in values] and got[5] == (None, "range")
    df = one_col(spark, values[:2]).select(F.lit("k").alias("k"), q.parse_memory_k8s("s").alias("b"))
    assert sum_quantity(df, ["k"], "b", "t").first().t == 2 ** 63 + 2 ** 20
    text = df.select(q.format_memory_k8s("b", "Mi").alias("x"), q.format_memory_jvm("b", "g").alias("y")).collect()
    assert [tuple(r) for r in text] == [("8796093022208Mi", "8589934592g"), ("1Mi", "0g")]


def test_integer_columns_and_missing_amounts(spark):
    df = spark.createDataFrame([(9007199254740993, 1, 2 ** 62), (None, 2, 5), (5, None, 5)], "q long, f long, g long")
    rows = df.select(q.scale_memory("q", F.col("f")).alias("m"), q.scale_cpu("q", F.col("f")).alias("c"), q.to_bytes("q").alias("b"),
                     q.to_m_cores("q").alias("k"), q.scale_memory("q", F.col("g")).alias("w"),
                     q.scale_memory_checked("q", 3).alias("i"), q.scale_memory_checked("q", 1.5).alias("d")).collect()
    assert rows[0][:5] == (9007199254740993, 9007199254740993, 9007199254740993, 9007199254740993000, 9007199254740993 * 2 ** 62)
    assert rows[1].i.reason == rows[1].d.reason == "type" and rows[2].m is None


# --- properties: the Spark grammar equals a scanner written by hand ---------

def scan(s, units):
    """(number text, unit) of a quantity, or None: digits, a point, digits, a unit, an optional last newline."""
    s = s[:-1] if s.endswith("\n") else s
    i, digits, points = 0, 0, 0
    while i < len(s) and (s[i] in "0123456789" or s[i] == "." and not points):
        digits, points, i = digits + (s[i] != "."), points + (s[i] == "."), i + 1
    return (s[:i], s[i:]) if digits and (s[i:] == "" or s[i:] in units) else None


def plain_memory_k8s(s):
    got = scan(s, q.K8S_UNITS)
    v = int(float(got[0]) * q.K8S_UNITS.get(got[1], 1)) if got else 0
    return v if 0 < v < 10 ** 38 else None


def plain_cpu_k8s(s):
    got = scan(s, ("m",))
    v = int(float(got[0]) * (1 if got[1] else 1000)) if got else 0
    return v if 0 < v < 2 ** 63 else None


texts = st.text(alphabet="0123456789.mMGiKk E\n", max_size=8)


@settings(max_examples=10, deadline=None)
@given(st.lists(texts, min_size=20, max_size=60))
def test_property_memory_and_cpu(spark, values):
    df = one_col(spark, values)
    rows = df.select("s", q.parse_memory_k8s("s").alias("m"), q.parse_cpu_k8s("s").alias("c")).collect()
    for r in rows:
        assert r.m == plain_memory_k8s(r.s), r.s
        assert r.c == plain_cpu_k8s(r.s), r.s


def plain_cpu_jvm(s):
    # Python's int() on text, ASCII digits and spaces only (the documented scope)
    if s.strip(" \t") != s.strip() or any(c not in "0123456789+-_ \t" for c in s):
        return None
    try:
        v = int(s) * 1000
    except ValueError:
        return None
    return v if 0 < v < 2 ** 63 else None


def plain_memory_jvm(s):
    got = scan(s, q.JVM_UNITS)
    v = int(got[0]) * q.JVM_UNITS.get(got[1], 1) if got and "." not in got[0] else 0
    return v if 0 < v < 10 ** 38 else None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-_ tgmk.", max_size=7), min_size=20, max_size=60))
def test_property_jvm_grammars(spark, values):
    df = one_col(spark, values)
    rows = df.select("s", q.parse_cpu_jvm("s").alias("c"), q.parse_memory_jvm("s").alias("m")).collect()
    for r in rows:
        assert r.c == plain_cpu_jvm(r.s), r.s
        assert r.m == plain_memory_jvm(r.s), r.s


def test_order_and_range_across_notations(spark):
    from corvid.operators.validate import quantity_range, sort_by_quantity
    df = spark.createDataFrame([("a", "1Gi"), ("a", "512Mi"), ("a", "2G"), ("b", "bad"), ("b", "1k")],
                               "k string, m string")
    assert [r.m for r in sort_by_quantity(df, "m", "memory_k8s").collect()] == ["1k", "512Mi", "1Gi", "2G", "bad"]
    got = {r.k: (r.min_m, r.max_m, r.n_valid_m) for r in quantity_range(df, ["k"], "m", "memory_k8s").collect()}
    assert got == {"a": (512 * 2 ** 20, 2 * 10 ** 9, 3), "b": (1000, 1000, 1)}


def test_where_quantity_several_bounds(spark):
    df = one_col(spark, ["512Mi", "1Gi", "1500M", "2Gi", "bad"])
    got = where_quantity(df, "s", ">=", "1024Mi", "memory_k8s", also=[("<", "2Gi")]).collect()
    assert sorted(r.s for r in got) == ["1500M", "1Gi"]


def plain_scale_cpu(m, f):
    v = int(((m / 1000) * f) * 1000)
    return v if 0 < v < 2 ** 63 else None


def plain_scale_memory(b, f):
    v = int(b * f)
    return v if 0 < v < 10 ** 38 else None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10 ** 12), st.floats(0, 1000, allow_nan=False)), min_size=10, max_size=50))
def test_property_scaling(spark, pairs):
    df = spark.createDataFrame(pairs, "q long, f double")
    rows = df.select("q", "f", q.scale_cpu("q", F.col("f")).alias("c"),
                     q.scale_memory("q", F.col("f")).alias("m")).collect()
    for r in rows:
        assert r.c == plain_scale_cpu(r.q, r.f), (r.q, r.f)
        assert r.m == plain_scale_memory(r.q, r.f), (r.q, r.f)


def test_dotted_column_names(spark):
    df = spark.createDataFrame([("a", "1Gi"), ("b", "bad")], "`t.id` string, `mem.k8s` string")
    good, bad = split_valid(df, "mem.k8s", "memory_k8s")
    assert [r["mem.k8s_value"] for r in good.collect()] == [2 ** 30]
    assert [r["mem.k8s_reason"] for r in bad.collect()] == ["pattern"]
    assert where_quantity(df, "mem.k8s", ">", "1Mi", "memory_k8s").count() == 1

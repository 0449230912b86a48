"""Name slugs (B26) and path stems (A13) against plain restatements."""

from __future__ import annotations

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corvid.functions.text import file_stem, folder_stem, named_path, slug
from corvid.plans.steps import path_stem


def plain_slug(*parts):
    s = "-".join(p for p in parts if p).lower().replace("'", "")
    s = re.sub(r"(?<=[0-9]),(?=[0-9])", "", s)
    return re.sub(r"[^a-z0-9]+", "-", s).strip("-")


names = st.text(alphabet="abcXYZ019 _-.,'#/", max_size=60)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(names, names), min_size=10, max_size=40))
def test_slug_property(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", slug("a", "b").alias("s")).collect():
        assert r.s == plain_slug(r.a, r.b), (r.a, r.b)


def test_slug_golden(spark):
    got = spark.range(1).select(slug(F.lit("adhoc_airflow"), F.lit("my_test_pyspark_task"))).first()[0]
    assert got == "adhoc-airflow-my-test-pyspark-task"


def test_slugs_are_cut_only_when_asked(spark):
    long = F.concat(F.repeat(F.lit("n"), 100), F.lit("-a"))
    got = spark.range(1).select(slug(long), slug(long, max_length=101)).first()
    assert got[0] == "n" * 100 + "-a" and got[1] == "n" * 100


def test_named_path(spark):
    df = spark.createDataFrame([("file:/x/My%20Movies+1%25.csv",)], "p string")
    assert df.select(file_stem(named_path("p"))).first()[0] == "my movies+1%"


def test_stems_match_the_step_helper(spark):
    paths = ["s3a://b/extract/Films.csv", "/data/x/Part.CSV", "/a/b/c/", "rel/name.csv.csv", "plain"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for r in df.select("p", file_stem("p").alias("f"), folder_stem("p").alias("d")).collect():
        assert r.f == r.p.lower().split("/")[-1].removesuffix(".csv")
        assert r.d == path_stem(r.p, "")

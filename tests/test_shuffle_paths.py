"""Joins chosen by Spark from real sizes: without broadcasts results must not change, and building a plan starts no job."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle_harness import compare, duck

KEYS = ["a10_land_raw", "b18_resolve_layers", "b20_conf_text", "b22_rank_placements"]


@pytest.fixture()
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", KEYS)
def test_without_broadcast(spark, sf_dir, no_broadcast, key):
    ok, msg = compare(queries()[key](spark, sf_dir), duck(sf_dir), oracle_sql()[key])
    assert ok, msg


@pytest.mark.parametrize("key", ["b18_resolve_layers", "b20_conf_text"])
def test_fleet_is_scanned_and_shuffled_once(spark, sf_dir, no_broadcast, key):
    df = queries()[key](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # one scan and exchange of the fleet; the overrides are derived from the same table by two aggregates
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") <= 3, plan


@pytest.mark.parametrize("key", ["b18_resolve_layers", "b20_conf_text", "b22_rank_placements"])
def test_building_a_plan_starts_no_job(spark, sf_dir, key):
    from corvid.session import table_path
    for t in ("orders", "customer", "supplier"):
        spark.read.parquet(table_path(sf_dir, t))
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", key)
    try:
        queries()[key](spark, sf_dir)
        ids = sc.statusTracker().getJobIdsForGroup("plan-only")
        stages = [sc.statusTracker().getJobInfo(i).stageIds for i in ids]
        # reading a table's schema is one job of one stage and one task
        assert all(len(s) == 1 and sc.statusTracker().getStageInfo(s[0]).numTasks == 1 for s in stages)
    finally:
        sc._jsc.clearJobGroup()

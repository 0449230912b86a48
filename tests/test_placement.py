"""Placement rules (B21) and ranking (B22) against a brute force."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from corvid.operators.placement import DRIVER_LABEL, EXECUTOR_LABEL, placement_rules, rank_placements


def brute_force(drivers, executors, nodes):
    zone = dict(nodes)
    tasks = {t for t, n in drivers} | {t for t, n in executors}
    best = {}
    for t in tasks:
        dh = {n for tt, n in drivers if tt == t and n in zone}
        sh = {n for tt, n in executors if tt == t and n in zone}
        dz, sz = {zone[n] for n in dh}, {zone[n] for n in sh}
        scored = [(100 * (n in dh) + 75 * (n in sh) + 50 * (z in dz) + 25 * (z in sz), -n) for n, z in nodes]
        s, neg = max(scored)
        lost = sum(tt == t and n not in zone for tt, n in drivers + executors)
        best[t] = (-neg if s > 0 else None, s, lost)
    return best


def test_rules_shape(spark):
    tasks = spark.createDataFrame([(1,), (2,)], "task_id long")
    rows = placement_rules(tasks).where("task_id = 1").orderBy("weight", ascending=False).collect()
    assert [r.weight for r in rows] == [100, 75, 50, 25]
    assert [r.label_key for r in rows] == [DRIVER_LABEL, EXECUTOR_LABEL, DRIVER_LABEL, EXECUTOR_LABEL]
    assert [r.topology_key for r in rows] == ["kubernetes.io/hostname", "kubernetes.io/hostname",
                                              "topology.kubernetes.io/zone", "topology.kubernetes.io/zone"]
    assert rows[0].label_value == rows[2].label_value != rows[1].label_value
    other = placement_rules(tasks).where("task_id = 2").collect()
    assert not {r.label_value for r in rows} & {r.label_value for r in other}


def test_rank_matches_brute_force(spark):
    rnd = random.Random(7)
    for trial in range(4):
        nodes = [(n, rnd.randrange(4)) for n in range(1, 25)]
        drivers = [(t, rnd.randrange(0, 27)) for t in range(1, 40)]
        executors = [(rnd.randrange(1, 45), rnd.randrange(0, 27)) for _ in range(120)]
        got = rank_placements(spark.createDataFrame(drivers, "task_id long, node long"),
                              spark.createDataFrame(executors, "task_id long, node long"),
                              spark.createDataFrame(nodes, "node long, zone int")).collect()
        assert {r.task_id: (r.node, r.score, r.unlisted_pods) for r in got} == brute_force(drivers, executors, nodes), trial


def test_stated_order_of_preference(spark):
    # driver host beats a sibling host elsewhere, which beats the driver's zone
    nodes = [(1, 0), (2, 0), (3, 1), (4, 2)]
    drivers = [(1, 3)]
    executors = [(1, 4)]
    got = rank_placements(spark.createDataFrame(drivers, "task_id long, node long"),
                          spark.createDataFrame(executors, "task_id long, node long"),
                          spark.createDataFrame(nodes, "node long, zone int")).first()
    assert (got.node, got.score) == (3, 150)


def test_no_pair_product_in_plan(spark):
    d = spark.createDataFrame([(1, 1)], "task_id long, node long")
    n = spark.createDataFrame([(1, 0)], "node long, zone int")
    plan = rank_placements(d, d, n)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_hot_task_with_a_third_of_all_executors(spark):
    # one task owns a third of all executor pods; the answer must still be exact
    rnd = random.Random(11)
    nodes = [(n, n % 6) for n in range(1, 61)]
    drivers = [(t, rnd.randrange(1, 61)) for t in range(1, 201)]
    executors = [(1, rnd.randrange(1, 61)) for _ in range(3000)] + \
                [(rnd.randrange(2, 201), rnd.randrange(1, 61)) for _ in range(6000)]
    got = rank_placements(spark.createDataFrame(drivers, "task_id long, node long"),
                          spark.createDataFrame(executors, "task_id long, node long"),
                          spark.createDataFrame(nodes, "node long, zone int")).collect()
    assert {r.task_id: (r.node, r.score, r.unlisted_pods) for r in got} == brute_force(drivers, executors, nodes)


def test_own_rules_replace_the_defaults(spark):
    df = spark.createDataFrame(
        [(1, [(10, "team", "a", "kubernetes.io/hostname")]), (2, None)],
        "task_id long, rules array<struct<weight:int,label_key:string,label_value:string,topology_key:string>>")
    got = placement_rules(df, own="rules").collect()
    assert [(r.weight, r.label_key) for r in got if r.task_id == 1] == [(10, "team")]
    assert [r.weight for r in got if r.task_id == 2] == [100, 75, 50, 25]


def test_ranking_follows_the_given_rules_and_names(spark):
    nodes = spark.createDataFrame([("a", "z1"), ("b", "z1"), ("c", "z2"), ("d", None)], "node string, zone string")
    drivers = spark.createDataFrame([("t1", "a"), ("t2", "b"), ("t3", "gone")], "task_id string, node string")
    executors = spark.createDataFrame([("t1", "c"), ("t2", "d"), ("t2", "gone")], "task_id string, node string")
    from corvid.operators.placement import affinity_id
    own = drivers.select("task_id", F.lit(7).alias("weight"), F.lit(EXECUTOR_LABEL).alias("label_key"),
                         affinity_id("executor", "task_id").alias("label_value"), F.lit("topology.kubernetes.io/zone").alias("topology_key"))
    got = {r.task_id: (r.node, r.score, r.unlisted_pods) for r in rank_placements(drivers, executors, nodes, rules=own).collect()}
    assert got == {"t1": ("c", 7, 0), "t2": (None, 0, 1), "t3": (None, 0, 1)}
    plain = {r.task_id: (r.node, r.score) for r in rank_placements(drivers, executors, nodes).collect()}
    assert plain == {"t1": ("a", 150), "t2": ("b", 150), "t3": (None, 0)}


def test_dotted_names(spark):
    d = spark.createDataFrame([(1, 2)], "`t.id` long, `n.id` long")
    n = spark.createDataFrame([(2, 0), (3, 0)], "`n.id` long, `z.id` int")
    got = rank_placements(d, d.limit(0), n, task="t.id", node="n.id", zone="z.id").collect()
    assert [(r["t.id"], r["n.id"], r.score) for r in got] == [(1, 2, 150)]
    assert placement_rules(d, task="t.id").count() == 4


def test_node_without_zone_keeps_host_points(spark):
    nodes = spark.createDataFrame([(1, None), (2, 7), (3, 7)], "node long, zone int")
    drivers = spark.createDataFrame([(1, 1)], "task_id long, node long")
    sibs = spark.createDataFrame([(1, 3)], "task_id long, node long")
    got = rank_placements(drivers, sibs, nodes).first()
    # node 1 (driver, no zone): 100; node 3 (sibling, zone 7 with a sibling): 75 + 25
    assert (got.node, got.score) == (1, 100)
    only_zone = rank_placements(spark.createDataFrame([(1, 2)], "task_id long, node long"),
                                sibs.limit(0), nodes).first()
    assert (only_zone.node, only_zone.score) == (2, 150)

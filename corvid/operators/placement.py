"""Executor placement preferences (B21) and their outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from corvid.operators.aggregate import col_of

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): labels, topology keys and the
# four weighted rules, in order.
DRIVER_LABEL = "spark-driver-affinity-id"
EXECUTOR_LABEL = "spark-executor-affinity-id"
HOST = "kubernetes.io/hostname"
ZONE = "topology.kubernetes.io/zone"
# (weight, whose label, topology)
RULES = [(100, "driver", HOST), (75, "executor", HOST), (50, "driver", ZONE), (25, "executor", ZONE)]
# ---------------------------------------------------------------------------

RULE = StructType([StructField("weight", IntegerType()), StructField("label_key", StringType()),
                   StructField("label_value", StringType()), StructField("topology_key", StringType())])


def affinity_id(component: str, task: Column | str) -> Column:
    """A stable per-task id shaped like a UUID (the reference draws a random
    one per render; deriving it makes reruns agree)."""
    t = F.col(task) if isinstance(task, str) else task
    h = F.sha2(F.concat(F.lit(f"{component}:"), t.cast("string")), 256)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def rule_structs(task: Column | str) -> list[tuple[int, str, Column, str]]:
    """The four rules as (weight, label key, label value, topology key)."""
    ids = {"driver": affinity_id("driver", task), "executor": affinity_id("executor", task)}
    label = {"driver": DRIVER_LABEL, "executor": EXECUTOR_LABEL}
    return [(w, label[who], ids[who], topo) for w, who, topo in RULES]


def rule_array(task: Column | str, own: Column | None = None) -> Column:
    """The four weighted rules of a task, or its own rules when given."""
    # of RULE's fields by construction: a cast that differs in nullability alone copies every struct
    default = F.array(*[F.struct(F.lit(w).alias("weight"), F.lit(k).alias("label_key"), v.alias("label_value"), F.lit(t).alias("topology_key"))
                        for w, k, v, t in rule_structs(task)])
    return default if own is None else F.coalesce(own, default)


def placement_rules(tasks: DataFrame, task: str = "task_id", own: str | None = None) -> DataFrame:
    """B21 on a table: one row per task and rule."""
    rules = rule_array(col_of(tasks, task), col_of(tasks, own) if own else None)
    return tasks.select(col_of(tasks, task), F.inline(rules))


def task_pods(drivers: DataFrame, executors: DataFrame, task: str = "task_id", node: str = "node") -> DataFrame:
    """Where the tasks' pods run, by the label that rules look for: (label_key, label_value, node)."""
    parts = [df.select(F.lit(label).alias("label_key"), affinity_id(who, col_of(df, task)).alias("label_value"),
                       col_of(df, node).alias("node"))
             for df, who, label in ((drivers, "driver", DRIVER_LABEL), (executors, "executor", EXECUTOR_LABEL))]
    return parts[0].unionByName(parts[1])


def rank_placements(drivers: DataFrame, executors: DataFrame, nodes: DataFrame, task: str = "task_id",
                    node: str = "node", zone: str = "zone", rules: DataFrame | None = None) -> DataFrame:
    """For a new executor of each task, the best node and its score.

    ``rules`` is B21's table (task, weight, label_key, label_value,
    topology_key), by default the four rules of every task. A rule holds on a
    node if a pod with its label runs in the same topology domain (the node
    itself, or its zone); each rule counts once per node, weights add up, the
    highest score wins, ties go to the lowest node. Nodes and zones may be
    numbers or names. A node without a zone label matches no zone rule.

    One row per task that has a pod or a rule: (task, node, score,
    unlisted_pods); the last counts the task's own pods on nodes that
    ``nodes`` does not list, which match no rule; a task none of whose rules
    holds anywhere has a null node and score 0.

    No task x node product: a node without host points only earns zone
    points, so the best of those in a zone is the zone's lowest node.
    Candidates are the hosts with points plus one node per zone with points.
    Pods shrink to distinct (label, node) rows before the join, so a task with
    a huge number of executors costs one row per host; the best candidate is
    row_number = 1, which Spark cuts per partition before it shuffles.
    """
    t = col_of(drivers, task)
    own = (drivers.select(t.alias("task"), col_of(drivers, node).alias("node"))
           .unionByName(executors.select(col_of(executors, task).alias("task"), col_of(executors, node).alias("node"))))
    if rules is None:
        rules = placement_rules(own.select("task").distinct(), "task")
    else:
        rules = rules.withColumnRenamed(task, "task")
    dim = nodes.select(col_of(nodes, node).alias("node"), col_of(nodes, zone).alias("zone"))
    wanted = (rules.groupBy("task", "label_key", "label_value", "topology_key")
              .agg(F.sum("weight").alias("weight")))
    pods = task_pods(drivers, executors, task, node).distinct().join(dim, "node")
    by_host = F.col("topology_key") == HOST
    held = (wanted.where(F.col("topology_key").isin(HOST, ZONE)).join(pods, ["label_key", "label_value"])
            .where(by_host | F.col("zone").isNotNull())
            .select("task", "zone", F.when(by_host, F.col("node")).alias("host"), "label_key", "label_value", "weight").distinct())
    hosts = held.where("host is not null").groupBy("task", "zone", "host").agg(F.sum("weight").alias("points"))
    zones = held.where("host is null").groupBy("task", "zone").agg(F.sum("weight").alias("zone_points"))
    on_host = (hosts.join(zones, ["task", "zone"], "left")
               .select("task", F.col("host").alias("node"), (F.col("points") + F.coalesce("zone_points", F.lit(0))).alias("score")))
    first = dim.where("zone is not null").groupBy("zone").agg(F.min("node").alias("node"))
    in_zone = zones.join(first, "zone").select("task", "node", F.col("zone_points").alias("score"))
    best = (on_host.unionByName(in_zone)
            .withColumn("rn", F.row_number().over(Window.partitionBy("task").orderBy(F.desc("score"), "node")))
            .where("rn = 1"))
    unlisted = (own.groupBy("task", "node").agg(F.count(F.lit(1)).alias("pods"))
                .join(dim.select("node", F.lit(True).alias("listed")), "node", "left")
                .groupBy("task").agg(F.sum(F.when(F.col("listed").isNull(), F.col("pods")).otherwise(0)).alias("unlisted_pods")))
    tasks = unlisted.unionByName(rules.select("task", F.lit(0).cast("bigint").alias("unlisted_pods")))
    tasks = tasks.groupBy("task").agg(F.sum("unlisted_pods").alias("unlisted_pods"))
    return (tasks.join(best, "task", "left")
            .select(F.col("task").alias(task), "node", F.coalesce("score", F.lit(0)).cast("int").alias("score"), "unlisted_pods")
            .withColumnRenamed("node", node))

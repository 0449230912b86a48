"""Shared pieces of the operators: table paths, written intermediate tables, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corvid.session import scratch_dir, table_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(c, UPPER, LOWER)


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage is cut and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stars(edges: DataFrame) -> bool:
    """Whether every node of (u, v) hangs on one root, which hangs on none."""
    if not edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected edge table: ``(node, root)``, root the least node.

    Alternating large-star and small-star rounds. Every round replaces links to larger
    neighbours by links to the least one, so chains halve and a hub of any size costs one row
    per member. Minima are partial aggregates; both sides of every join are written tables, so a
    hot node is a plain skewed join, which AQE splits. Nodes may be of any ordered type. Loops
    and null ends are ignored; a node without an edge to another one has no row.
    """
    cur = saved(edges.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-edges")
    while not _stars(cur):
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        large = saved(both.join(least, "u").where(F.col("v") > F.col("u"))
                      .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "cc-large")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        small = (large.join(least, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        cur = saved(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

"""Inputs for the fleet-configuration jobs, derived by Spark from the driver's
tables (FIXTURES.md section 3), so their size grows with the tables.

Every builder here has a SQL twin in :mod:`corvid.plans.oracle` that DuckDB
runs on the same parquet files.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from corvid.functions.tokens import encode_token
from corvid.session import table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _case(key, pairs, default):
    expr = None
    for k, v in pairs:
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def fx_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity texts in three grammars, one row per line item (B01-B13): every
    unit, nulls, blanks, zeros, and values past 64 bits."""
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int").cast("string")
    pk = F.col("l_partkey")
    mem_k8s = F.concat(q, _case(pk % 20, [
        (0, "Mi"), (1, "Gi"), (2, "Ki"), (3, ""), (4, "M"), (5, "k"), (6, ".5Gi"), (7, "G"), (8, "bad"), (9, "Ti"), (10, "Pi"),
        (11, "Ei"), (12, "T"), (13, "P"), (14, "E"), (15, "000Ei"), (16, " Mi")], "Mi"))
    mem_k8s = (F.when(pk % 20 == 17, F.lit(None)).when(pk % 20 == 18, "").when(pk % 20 == 19, "0Gi").otherwise(mem_k8s))
    mem_jvm = F.concat(q, _case(pk % 10, [(0, "k"), (1, "m"), (2, "g"), (3, "t"), (4, ""), (5, "0000000t"),
                                          (6, "00000000000000000000000000000000000000k")], "G"))
    mem_jvm = F.when(pk % 10 == 8, F.lit(None)).when(pk % 10 == 9, "0m").otherwise(mem_jvm)
    cpu_k8s = (F.when(pk % 9 == 0, F.concat(q, F.lit("00m")))
               .when(pk % 9 == 1, q)
               .when(pk % 9 == 2, F.concat(F.lit("0."), q))
               .when(pk % 9 == 3, F.concat(q, F.lit(".001")))
               .when(pk % 9 == 4, F.lit("0.0001"))
               .when(pk % 9 == 5, F.concat(q, F.lit("000000000000000000000")))
               .when(pk % 9 == 6, "")
               .when(pk % 9 == 7, F.lit(None))
               .otherwise(F.lit("x")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     mem_k8s.alias("mem_k8s"), mem_jvm.alias("mem_jvm"), cpu_k8s.alias("cpu_k8s"))


def fx_task_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task configuration per order."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("task_id"),
        F.col("o_custkey").alias("owner_id"),
        _case(F.col("o_orderstatus"), [("F", "local"), ("O", "client")], "connect").alias("deploy_mode"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.lit(512) * (1 + k % 16)).cast("bigint").alias("memory_mib"),
        F.when(k % 3 == 0, F.lit(128) * (1 + k % 4)).cast("bigint").alias("overhead_mib"),
        # a decimal product, as in SQL, so 0.1 * 3 is exactly 0.3 before the double cast
        F.when(k % 8 == 5, F.lit(0.0005)).when(k % 4 == 1, (F.lit(Decimal("0.1")) * (1 + k % 3)).cast("double"))
        .alias("overhead_factor"),
        (F.lit(250) * (1 + F.col("o_custkey") % 8)).cast("bigint").alias("request_m_cores"),
        F.when(k % 5 == 0, F.lit(None)).otherwise((1 + k % 6).cast("int")).alias("instances"),
    )


def fx_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The task configurations in canonical units: one fleet row per task.

    The driver has columns of its own; ``unset`` names what a row leaves to
    the default, so ``driver_memory`` and ``instances`` hold all three states
    (value, null, not set); some urls are empty.
    """
    t = fx_task_conf(spark, sf_dir)
    k = F.col("task_id")
    return t.select("task_id", "owner_id", "deploy_mode",
                    (F.col("memory_mib") * (1 << 20)).alias("memory"),
                    (F.col("overhead_mib") * (1 << 20)).alias("memory_overhead"),
                    F.col("overhead_factor").alias("memory_overhead_factor"),
                    F.col("request_m_cores").alias("request_cores"), "instances",
                    F.when(k % 10 != 7, F.lit(2 << 30) * (1 + k % 3)).cast("bigint").alias("driver_memory"),
                    (F.lit(500) * (1 + k % 4)).cast("bigint").alias("driver_request_cores"),
                    F.when(k % 13 == 0, "").when(k % 17 == 0, "k8s://other:443").alias("spark_url"),
                    F.array_compact(F.array(F.when(k % 10 == 3, "driver_memory"), F.when(k % 15 == 0, "instances"))).alias("unset"))


def fleet_env() -> dict:
    """Sentinel look-ups for the fleet: fixed values, and a per-task host."""
    return {"namespace": "team-a", "service_account": "airflow-worker",
            "aws_role_arn": "default", "hostname": F.concat(F.lit("worker-"), F.col("task_id").cast("string")),
            "ip": "10.0.0.1"}


def fx_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster nodes and their zones, by name."""
    return table(spark, sf_dir, "supplier").select(_node(F.col("s_suppkey")).alias("node"),
                                                   F.concat(F.lit("zone-"), F.col("s_nationkey").cast("string")).alias("zone"))


def _node(number):
    return F.concat(F.lit("node-"), number.cast("string"))


def _n_nodes(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()


def fx_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each task's driver runs."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("task_id"),
                    _node(F.col("c_custkey") % _n_nodes(spark, sf_dir)).alias("node"))


def fx_executor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executors already placed, by task (B22): every order is one executor;
    some run on nodes that are not listed."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("pod_id"), F.col("o_custkey").alias("task_id"),
                    _node((F.col("o_orderkey") * 7) % (_n_nodes(spark, sf_dir) + 3)).alias("node"))


def fx_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-task extra settings; a null value deletes the key.

    Every 7th task changes one rendered key, deletes another and adds a key
    of one of 1500 names; every 14th gives one key twice (the later counts);
    every 21st deletes a key that is absent; every 35th names a task that the
    fleet does not have.
    """
    tasks = fx_task_conf(spark, sf_dir).select("task_id")
    t = F.col("task_id")

    def entry(n, key, value, keep, task=t):
        return F.struct(task.alias("task_id"), F.lit(n).alias("n"), (F.lit(key) if isinstance(key, str) else key).alias("key"),
                        F.lit(value).cast("string").alias("value"), keep.alias("keep"))
    entries = F.array(
        entry(0, "spark.shuffle.file.buffer", "4m", t % 7 == 0),
        entry(1, "spark.executor.extraLibraryPath", None, t % 7 == 0),
        entry(2, "spark.eventLog.enabled", "true", t % 14 == 0),
        entry(3, "spark.jars.packages", None, t % 21 == 0),
        entry(4, F.concat(F.lit("spark.extra.k"), (t % 1500).cast("string")), "x", t % 7 == 0),
        entry(5, "spark.eventLog.enabled", "false", t % 14 == 0),
        entry(6, "spark.driver.memory", "9g", t % 35 == 0, -t - 1),
    )
    return tasks.select(F.inline(entries)).where("keep").select("task_id", "n", "key", "value")


def fx_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One service-account token per customer (B25). Every 17th token is
    corrupt; every 19th names no account (the claim falls back to ``default``)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # dealt out while rows are narrow: the table's file is one task per row group, and a token takes long to make
    c = c.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.col("c_custkey")
    account = F.struct(
        F.when(key % 19 != 0, F.concat(F.lit("sa-"), F.lower("c_mktsegment"))).alias("name"),
        F.concat(F.lit("uid-"), key.cast("string")).alias("uid"))
    claims = F.struct(
        F.array(F.lit("https://kubernetes.default.svc")).alias("aud"),
        (F.lit(1700000000) + key).alias("exp"),
        F.lit(1690000000).alias("iat"),
        F.lit("https://issuer.example").alias("iss"),
        F.lit(1690000000).alias("nbf"),
        F.concat(F.lit("system:serviceaccount:ns:"), key.cast("string")).alias("sub"),
        F.struct(F.concat(F.lit("ns-"), F.col("c_nationkey").cast("string")).alias("namespace"),
                 F.struct(F.concat(F.lit("pod-"), key.cast("string")).alias("name"),
                          F.lit("p").alias("uid")).alias("pod"),
                 account.alias("serviceaccount"),
                 F.lit(1690003600).alias("warnafter")).alias("kubernetes.io"),
    )
    token = encode_token(F.lit('{"alg":"RS256","kid":"k1"}'), F.to_json(claims),
                         F.unhex(F.sha2(key.cast("string"), 256)))
    token = F.when(key % 17 == 0, F.concat(F.lit("e30.not*base64!."), key.cast("string"))).otherwise(token)
    return c.select(key.alias("task_id"), token.alias("token"))


def elt_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ELT input as text fields with blanks after the separators, as in
    the reference's example file: ``Year``, ``Score``, ``Title``."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit(" "), F.year("o_orderdate").cast("string")).alias("Year"),
                    F.concat(F.lit(" "), F.col("o_totalprice").cast("string")).alias("Score"),
                    F.concat(F.lit(" "), F.col("o_orderpriority")).alias("Title"))


def elt_flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ELT input with values that are no numbers (A11): every 17th ``Score``, every 29th ``Year``; an empty
    ``Score``, which is null and no flaw, every 13th."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    score = F.when(k % 17 == 0, "n/a").when(k % 13 == 0, "").otherwise(F.col("o_custkey").cast("string"))
    year = F.when(k % 29 == 0, "MM").otherwise(F.year("o_orderdate").cast("string"))
    return o.select("o_orderkey", F.concat(F.lit(" "), year).alias("Year"), F.concat(F.lit(" "), score).alias("Score"),
                    F.concat(F.lit(" "), F.col("o_orderpriority")).alias("Title"))


def elt_flawed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as lines; every 23rd has a field too many, every 31st one too few."""
    k = F.col("o_orderkey")
    fields = F.when(k % 31 == 0, F.concat_ws(",", "Year", "Score")).otherwise(F.concat_ws(",", "Year", "Score", "Title"))
    return elt_flawed(spark, sf_dir).select(F.when(k % 23 == 0, F.concat(fields, F.lit(", x"))).otherwise(fields).alias("value"))


def crlf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that end in a carriage return, by order status (A10)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat_ws(",", F.col("o_orderkey").cast("string"), F.concat(F.col("o_orderpriority"), F.lit("\r"))).alias("value"),
                    F.col("o_orderstatus").alias("status"))


def fx_namespaces(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fleet rows in namespaces, null for some, and a look-up table of their values (B19): the last namespaces are
    missing from it, the null one is in it, and every third has no role."""
    k = F.col("task_id")
    fleet = fx_fleet(spark, sf_dir).withColumns({
        "namespace": F.when(k % 50 != 0, F.concat(F.lit("ns-"), (k % 25).cast("string"))),
        "service_account_name": F.when(k % 4 != 0, "__AUTODETECT__").otherwise("own")})
    n = table(spark, sf_dir, "nation").where("n_nationkey < 20")
    name = F.concat(F.lit("ns-"), F.col("n_nationkey").cast("string"))
    lookup = n.select(F.when(F.col("n_nationkey") != 7, name).alias("namespace"), F.concat(F.lit("sa-"), F.lower("n_name")).alias("service_account"),
                      F.when(F.col("n_nationkey") % 3 != 0, F.concat(F.lit("arn:"), name)).alias("aws_role_arn"))
    return fleet, lookup


def write_csv_fixture(df: DataFrame, dst: str, files: int | None = None, fixed_name: str | None = None) -> str:
    """Write text columns as CSV with a header, keeping leading blanks. With
    ``fixed_name`` the files lie in a folder of that name below ``dst``."""
    if files is not None:
        df = df.repartition(files)
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(f"{dst}/{fixed_name}" if fixed_name else dst))
    return dst

"""Registered queries, one per inventory item, each with its DuckDB twin.

Every query reads the driver's tables at ``sf_dir`` (or data Spark derives
from them) in full. Queries that store intermediate results write under a
fresh folder below the session's shared checkpoint root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType

from corvid.functions import quantity as q
from corvid.functions.text import file_stem, folder_stem, named_path, parent_folder, slug
from corvid.operators import settings as st
from corvid.operators.aggregate import group_avg, sort_by, sum_quantity
from corvid.operators.documents import pod_labels, render_pod_json, tokens_per_account
from corvid.operators.inspect import preview, profile
from corvid.operators.placement import (DRIVER_LABEL, EXECUTOR_LABEL, HOST, RULE, ZONE, affinity_id, placement_rules,
                                        rank_placements)
from corvid.operators.resources import request_memory, requests_rollup
from corvid.operators.validate import (quantity_range, sort_by_quantity, split_valid, where_quantity, with_parsed,
                                       write_valid)
from corvid.plans import fixtures as fx
from corvid.plans import oracle_docs as odoc
from corvid.plans import oracle_settings as osql
from corvid.plans.oracle import FX_QUANTITY, FX_TASK_CONF, parse_sql, with_
from corvid.plans.steps import (load_step, rejected_of, run_pipeline, sql_step, step, transform_step,
                                with_scalar)
from corvid.session import scratch_dir, table_path
from corvid.sources.files import land_raw, read_csv, read_parquet, write_parquet
from corvid.sources.landing import land_files, verify_landing
from corvid.sources.rejects import accepted, rejected
from corvid.streaming.incremental import loaded, stream_load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------
# Tier A: the ELT path
# --------------------------------------------------------------------------

ELT_ROWS_SQL = ("select cast(year(o_orderdate) as integer) as Year, o_totalprice as Score, "
                "o_orderpriority as Title from orders")
ELT_AVG_SQL = ("select cast(year(o_orderdate) as integer) as Year, round(avg(o_totalprice), 6) as avg_score "
               "from orders group by 1")


def _elt_csv(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, str]:
    """Write the ELT input as CSV, one file per input split (no funnelling
    into a fixed number of writers)."""
    root = scratch_dir(spark, label)
    src = fx.write_csv_fixture(fx.elt_source(spark, sf_dir), f"{root}/source/movies.csv")
    return root, src


def _elt_rows(df: DataFrame) -> DataFrame:
    return df.select("Year", "Score", "Title")


def _avg_out(df: DataFrame) -> DataFrame:
    return df.select("Year", F.round(F.col("avg(Score)"), 6).alias("avg_score"))


@register("a03_read_csv", ELT_ROWS_SQL)
def a03_read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, src = _elt_csv(spark, sf_dir, "a03")
    return _elt_rows(read_csv(spark, src))


@register("a04_read_parquet", "select * from orders")
def a04_read_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, table_path(sf_dir, "orders"))


@register("a05_write_parquet", "select * from customer")
def a05_write_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    dst = f"{scratch_dir(spark, 'a05')}/customer/"
    customer = read_parquet(spark, table_path(sf_dir, "customer"))
    write_parquet(customer, dst)
    return read_parquet(spark, write_parquet(customer, dst))  # the second write replaces the first


@register("a05_replace_in_place", "select * from customer where c_custkey % 2 = 0")
def a05_replace_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a part of itself."""
    dst = f"{scratch_dir(spark, 'a05r')}/customer/"
    write_parquet(read_parquet(spark, table_path(sf_dir, "customer")), dst)
    return read_parquet(spark, write_parquet(read_parquet(spark, dst).where("c_custkey % 2 = 0"), dst))


def _profile_sql() -> str:
    cols = [("o_orderkey", "bigint", True), ("o_custkey", "bigint", True),
            ("o_orderstatus", "string", False), ("o_totalprice", "double", True),
            ("o_orderdate", "timestamp_ntz", False), ("o_orderpriority", "string", False)]
    parts = []
    for i, (c, t, num) in enumerate(cols):
        lo, hi = (f"cast(min({c}) as double)", f"cast(max({c}) as double)") if num else ("null", "null")
        tl, th = ("null", "null") if t == "double" else (f"cast(min({c}) as varchar)", f"cast(max({c}) as varchar)")
        parts.append(f"select '{c}' as column_name, {i} as ordinal, '{t}' as data_type, count(*) as n_rows, "
                     f"count(*) - count({c}) as n_nulls, {lo} as min_num, {hi} as max_num, "
                     f"{tl} as min_text, {th} as max_text from orders")
    return "\nunion all ".join(parts)


@register("a06_profile", _profile_sql())
def a06_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(read_parquet(spark, table_path(sf_dir, "orders")))


@register("a07_preview", "select * from lineitem order by l_orderkey, l_linenumber limit 20")
def a07_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(read_parquet(spark, table_path(sf_dir, "lineitem")), ["l_orderkey", "l_linenumber"], 20)


@register("a08_group_avg",
          "select l_returnflag, l_linestatus, round(avg(l_quantity), 6) as avg_qty, "
          "round(avg(l_extendedprice), 6) as avg_price, round(avg(l_discount), 6) as avg_disc "
          "from lineitem group by 1, 2")
def a08_group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_parquet(spark, table_path(sf_dir, "lineitem"))
    g = group_avg(li, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount"])
    return g.select("l_returnflag", "l_linestatus",
                    F.round("avg(l_quantity)", 6).alias("avg_qty"),
                    F.round("avg(l_extendedprice)", 6).alias("avg_price"),
                    F.round("avg(l_discount)", 6).alias("avg_disc"))


@register("a09_sort_by",
          "select o_orderstatus, o_totalprice, o_orderkey from orders order by 1, 2, 3")
def a09_sort_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_parquet(spark, table_path(sf_dir, "orders"))
    return sort_by(o.select("o_orderstatus", "o_totalprice", "o_orderkey"),
                   ["o_orderstatus", "o_totalprice", "o_orderkey"])


@register("a10_land_raw", ELT_ROWS_SQL)
def a10_land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders that hold files of the same names, every row back."""
    root = scratch_dir(spark, "a10")
    rows = fx.elt_source(spark, sf_dir)
    for i in range(2):
        fx.write_csv_fixture(rows.where(F.pmod(F.xxhash64("Score"), F.lit(2)) == i), f"{root}/raw/{i}", fixed_name="movies.csv")
    landed = land_raw(spark, f"{root}/raw/*/*/*.csv", f"{root}/extract")
    return _elt_rows(read_csv(spark, landed, recursive=True))


def _hash_sum(line: str) -> str:
    return f"cast(sum(cast('0x' || substr(md5({line}), 1, 8) as bigint)) as bigint)"


@register("a10_land_files",
          "with t as (select o_orderstatus as status, o_orderkey || ',' || o_orderpriority || chr(13) as line from orders) "
          "select 'status=' || status as folder, cast(sum(octet_length(line::blob) + 1) as bigint) as n_bytes, true as identical, "
          f"count(*) as n_lines, {_hash_sum('line')} as lines_hash from t group by status "
          "union all select 'status=none', 0, true, 0, 0")
def a10_land_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with CRLF ends and an empty one, landed byte by byte, checked against their digests and read as they lie there."""
    root = scratch_dir(spark, "a10f")
    fx.crlf_lines(spark, sf_dir).write.partitionBy("status").text(f"{root}/raw")
    spark.range(0).select(F.lit("").alias("value")).coalesce(1).write.text(f"{root}/raw/status=none")
    dst = land_files(spark, f"{root}/raw/*/part-*", f"{root}/extract", range_bytes=1 << 20)
    files = verify_landing(spark, dst).groupBy(F.split_part("source", F.lit("/"), F.lit(1)).alias("folder")).agg(
        F.sum("n_bytes").alias("n_bytes"), F.bool_and("identical").alias("identical"))
    lines = (spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(dst)
             .select("value", F.split_part(named_path("_metadata.file_path"), F.lit("/"), F.lit(-2)).alias("folder")))
    number = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("bigint")
    read = lines.groupBy("folder").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(number).alias("lines_hash"))
    return files.join(read, "folder", "left").select(
        "folder", "n_bytes", "identical", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("lines_hash", F.lit(0)).alias("lines_hash"))


@register("a11_load_step", ELT_ROWS_SQL)
def a11_load_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, src = _elt_csv(spark, sf_dir, "a11")
    return _elt_rows(read_parquet(spark, load_step(spark, src, root)))


@register("a11_stream_load", ELT_ROWS_SQL)
def a11_stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, src = _elt_csv(spark, sf_dir, "a11s")
    dst = stream_load(spark, src, f"{root}/load_stream/movies", checkpoint=f"{root}/_stream_checkpoint")
    return _elt_rows(read_parquet(spark, dst))


FLAWED_SCHEMA = "Year int, Score bigint, Title string"
_FLAWED_SQL = """with f as (select o_orderkey as k, case when o_orderkey % 29 = 0 then 'MM' else cast(year(o_orderdate) as varchar) end as y,
  case when o_orderkey % 17 = 0 then 'n/a' when o_orderkey % 13 = 0 then '' else cast(o_custkey as varchar) end as s, o_orderpriority as p from orders),
w as (select *, concat_ws(', ', case when k % 29 = 0 then 'Year is no int' end, case when k % 17 = 0 then 'Score is no bigint' end) as wrong from f)
"""
_LINES_SQL = _FLAWED_SQL + """, l as (select *, ' ' || y || ', ' || s || case when k % 31 = 0 then '' else ', ' || p end
  || case when k % 23 = 0 then ', x' else '' end as line, (k % 31 = 0) <> (k % 23 = 0) as uneven,
  k % 31 = 0 and k % 23 = 0 as both_odd from w)
"""


def _flawed_load(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, str]:
    root = scratch_dir(spark, label)
    src = f"{root}/source/scores.csv"
    fx.elt_flawed_lines(spark, sf_dir).write.text(src)
    return load_step(spark, src, root, FLAWED_SCHEMA, quarantine=True, header=False), rejected_of(src, root)


@register("a11_quarantine", _LINES_SQL + "select 'scores' as source, line, case when uneven then 'fields' else wrong end as reason "
          "from l where uneven or wrong <> ''")
def a11_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that a load sets aside, with file and reason."""
    bad = rejected(read_parquet(spark, _flawed_load(spark, sf_dir, "a11q")[1]))
    return bad.select(file_stem(parent_folder("file")).alias("source"), "line", "reason")


@register("a11_quarantine_good", _LINES_SQL + "select try_cast(y as integer) as Year, try_cast(nullif(s, '') as bigint) as Score, "
          "case when both_odd then 'x' else p end as Title from l where not uneven and wrong = ''")
def a11_quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same load keeps."""
    return accepted(read_parquet(spark, _flawed_load(spark, sf_dir, "a11g")[0]))


@register("a11_stream_quarantine", _FLAWED_SQL + "select 'scores' as source, ' ' || y || ', ' || s || ', ' || p as line, wrong as reason "
          "from w where wrong <> ''")
def a11_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the incremental load."""
    root = scratch_dir(spark, "a11sq")
    src = fx.write_csv_fixture(fx.elt_flawed(spark, sf_dir).drop("o_orderkey"), f"{root}/source/scores.csv")
    dst = stream_load(spark, src, f"{root}/load_stream/scores", FLAWED_SCHEMA, checkpoint=f"{root}/_stream_checkpoint", quarantine=True)
    return loaded(spark, dst)[1].select(file_stem(parent_folder("file")).alias("source"), "line", "reason")


@register("a12_transform_step", ELT_AVG_SQL)
def a12_transform_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, src = _elt_csv(spark, sf_dir, "a12")
    return _avg_out(read_parquet(spark, transform_step(spark, load_step(spark, src, root), root)))


@register("a13_path_stem",
          "select 'my films ' || lower(o_orderstatus) || '+1' as stem, 'status=' || lower(o_orderstatus) as folder, "
          "count(*) as n_rows from orders group by 1, 2")
def a13_path_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose names hold blanks and signs, named by their paths."""
    root = f"{scratch_dir(spark, 'a13')}/by_status"
    o = read_parquet(spark, table_path(sf_dir, "orders")).select("o_orderkey", "o_orderstatus")
    for status in [r[0] for r in o.select("o_orderstatus").distinct().collect()]:  # three fixed values
        (o.where(F.col("o_orderstatus") == status).select("o_orderkey").write.mode("overwrite").option("header", True)
         .csv(f"{root}/status={status}/My Films {status}+1.CSV"))
    files = (spark.read.option("header", True).option("recursiveFileLookup", True).csv(root)
             .select(parent_folder(named_path("_metadata.file_path")).alias("file")))
    return (files.groupBy(file_stem("file").alias("stem"), folder_stem(parent_folder("file")).alias("folder"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("a14_run_pipeline", ELT_AVG_SQL)
def a14_run_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, src = _elt_csv(spark, sf_dir, "a14")
    return _avg_out(run_pipeline(spark, [load_step, transform_step], src, root))


class _Broken(Exception):
    """The break of the chain in ``a14_resume``."""


@register("a14_resume", f"select 1 as n_loads, 2 as n_transforms, * from ({ELT_AVG_SQL})")
def a14_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain that breaks at its second step and is started again: the first step runs once."""
    root, src = _elt_csv(spark, sf_dir, "a14r")
    ran = {"load": 0, "transform": 0}

    def load(spark, uri, root):
        ran["load"] += 1
        return load_step(spark, uri, root)

    def transform(spark, uri, root):
        ran["transform"] += 1
        if ran["transform"] == 1:
            raise _Broken
        return transform_step(spark, uri, root)
    try:
        run_pipeline(spark, [load, transform], src, root, resume=True)
    except _Broken:
        pass
    done = _avg_out(run_pipeline(spark, [load, transform], src, root, resume=True))
    return done.select(F.lit(ran["load"]).alias("n_loads"), F.lit(ran["transform"]).alias("n_transforms"), "*")


@register("a15_sql_step",
          "select o_orderstatus, count(*) as n_orders, round(sum(o_totalprice), 2) as revenue "
          "from orders where o_totalprice > 100000.0 and o_orderpriority <> '5-LOW' group by o_orderstatus")
def a15_sql_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_step(
        spark,
        "select o_orderstatus, count(*) as n_orders, round(sum(o_totalprice), 2) as revenue "
        "from {orders} where o_totalprice > :min_price and o_orderpriority <> :skip group by o_orderstatus",
        args={"min_price": 100000.0, "skip": "5-LOW"},
        orders=read_parquet(spark, table_path(sf_dir, "orders")))


@register("a16_with_scalar",
          with_(FX_TASK_CONF) +
          "select task_id, coalesce(instances, (select 1 + count(*) % 3 from supplier)) as executors "
          "from fx_task_conf")
def a16_with_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = read_parquet(spark, table_path(sf_dir, "supplier")).select(
        (F.lit(1) + F.count(F.lit(1)) % 3).alias("n"))
    tasks = with_scalar(fx.fx_task_conf(spark, sf_dir), chosen, "n_default")
    return tasks.select("task_id", F.coalesce(F.col("instances").cast("bigint"),
                                              F.col("n_default")).alias("executors"))


@step
def yearly_orders(sf_dir: str, spark: SparkSession) -> DataFrame:
    o = read_parquet(spark, table_path(sf_dir, "orders"))
    return (o.groupBy(F.year("o_orderdate").alias("year"))
            .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue")))


@register("a17_step",
          "select cast(year(o_orderdate) as integer) as year, count(*) as n_orders, "
          "round(sum(o_totalprice), 2) as revenue "
          "from orders group by 1")
def a17_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yearly_orders(sf_dir=sf_dir)  # the step passes the active session


# --------------------------------------------------------------------------
# Tier B: quantities
# --------------------------------------------------------------------------

def _parse_query_sql(kind: str, src: str, value: str) -> str:
    v, r = parse_sql(kind, src)
    v = f"cast({v} as decimal(38,0))" if kind.startswith("memory") else v
    return (with_(FX_QUANTITY) +
            f"select l_orderkey, l_linenumber, {src}, {v} as {value}, {r} as reason from fx_quantity")


def _parse_query(spark: SparkSession, sf_dir: str, src: str, kind: str, value: str) -> DataFrame:
    parsed = with_parsed(fx.fx_quantity(spark, sf_dir), src, kind, value, "reason")
    return parsed.select("l_orderkey", "l_linenumber", src, value, "reason")


@register("b01_parse_memory_k8s", _parse_query_sql("memory_k8s", "mem_k8s", "bytes"))
def b01_parse_memory_k8s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parse_query(spark, sf_dir, "mem_k8s", "memory_k8s", "bytes")


@register("b02_parse_memory_jvm", _parse_query_sql("memory_jvm", "mem_jvm", "bytes"))
def b02_parse_memory_jvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parse_query(spark, sf_dir, "mem_jvm", "memory_jvm", "bytes")


@register("b03_parse_cpu_k8s", _parse_query_sql("cpu_k8s", "cpu_k8s", "m_cores"))
def b03_parse_cpu_k8s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parse_query(spark, sf_dir, "cpu_k8s", "cpu_k8s", "m_cores")


@register("b04_parse_cpu_jvm", _parse_query_sql("cpu_jvm", "cpu_k8s", "m_cores"))
def b04_parse_cpu_jvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parse_query(spark, sf_dir, "cpu_k8s", "cpu_jvm", "m_cores")


def _fmt_sql(expr: str, div: int, unit: str) -> str:
    return f"cast(({expr}) // {div} as varchar) || '{unit}'"


def _b05_sql() -> str:
    v, _ = parse_sql("memory_k8s", "mem_k8s")
    return (with_(FX_QUANTITY) +
            f"select l_orderkey, l_linenumber, {_fmt_sql(v, 2**20, 'Mi')} as mem_mi, "
            f"{_fmt_sql(v, 2**30, 'Gi')} as mem_gi, {_fmt_sql(v, 10**3, 'k')} as mem_k, "
            f"cast({v} as varchar) as mem_bytes from fx_quantity")


@register("b05_format_memory_k8s", _b05_sql())
def b05_format_memory_k8s(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("bytes")
    return with_parsed(fx.fx_quantity(spark, sf_dir), "mem_k8s", "memory_k8s", "bytes").select(
        "l_orderkey", "l_linenumber", q.format_memory_k8s(b, "Mi").alias("mem_mi"),
        q.format_memory_k8s(b, "Gi").alias("mem_gi"), q.format_memory_k8s(b, "k").alias("mem_k"),
        q.format_memory_k8s(b, None).alias("mem_bytes"))


def _b06_sql() -> str:
    v, _ = parse_sql("memory_jvm", "mem_jvm")
    return (with_(FX_QUANTITY) +
            f"select l_orderkey, l_linenumber, {_fmt_sql(v, 2**20, 'm')} as jvm_m, "
            f"{_fmt_sql(v, 2**30, 'g')} as jvm_g, {_fmt_sql(v, 2**40, 't')} as jvm_t from fx_quantity")


@register("b06_format_memory_jvm", _b06_sql())
def b06_format_memory_jvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("bytes")
    return with_parsed(fx.fx_quantity(spark, sf_dir), "mem_jvm", "memory_jvm", "bytes").select(
        "l_orderkey", "l_linenumber", q.format_memory_jvm(b, "m").alias("jvm_m"),
        q.format_memory_jvm(b, "g").alias("jvm_g"), q.format_memory_jvm(b, "t").alias("jvm_t"))


def _b07_sql() -> str:
    v, _ = parse_sql("cpu_k8s", "cpu_k8s")
    return (with_(FX_QUANTITY) +
            f"select l_orderkey, l_linenumber, cast({v} as varchar) || 'm' as cpu_text from fx_quantity")


@register("b07_format_cpu_k8s", _b07_sql())
def b07_format_cpu_k8s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_parsed(fx.fx_quantity(spark, sf_dir), "cpu_k8s", "cpu_k8s", "m").select(
        "l_orderkey", "l_linenumber", q.format_cpu_k8s("m").alias("cpu_text"))


def _b08_sql() -> str:
    v, _ = parse_sql("cpu_k8s", "cpu_k8s")
    return (with_(FX_QUANTITY) +
            f"select l_orderkey, l_linenumber, cast(({v}) // 1000 as varchar) as cores from fx_quantity")


@register("b08_format_cpu_jvm", _b08_sql())
def b08_format_cpu_jvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_parsed(fx.fx_quantity(spark, sf_dir), "cpu_k8s", "cpu_k8s", "m").select(
        "l_orderkey", "l_linenumber", q.format_cpu_jvm("m").alias("cores"))


def _pos(expr: str) -> str:
    return f"case when ({expr}) > 0 then ({expr}) end"


@register("b09_to_bytes",
          "select l_orderkey, l_linenumber, "
          f"cast({_pos('cast(trunc(l_quantity * 1048576.0) as bigint)')} as decimal(38,0)) as qty_mib_bytes, "
          f"cast({_pos('cast(l_linenumber as bigint) * 1073741824')} as decimal(38,0)) as line_gib_bytes, "
          f"{_pos('cast(trunc(l_tax * 1000.0) as bigint)')} as tax_m_cores, "
          f"{_pos('cast(l_linenumber as bigint) * 1000')} as line_m_cores from lineitem")
def b09_to_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_parquet(spark, table_path(sf_dir, "lineitem"))
    return li.select("l_orderkey", "l_linenumber",
                     q.to_bytes("l_quantity", "Mi").alias("qty_mib_bytes"),
                     q.to_bytes("l_linenumber", "Gi").alias("line_gib_bytes"),
                     q.to_m_cores("l_tax").alias("tax_m_cores"),
                     q.to_m_cores("l_linenumber").alias("line_m_cores"))


def _b10_sql() -> str:
    v, _ = parse_sql("memory_k8s", "mem_k8s")
    return (with_(FX_QUANTITY) +
            f"select l_suppkey, sum(cast({v} as decimal(38,0))) as total_bytes, count({v}) as n_valid "
            "from fx_quantity group by l_suppkey")


@register("b10_sum_quantity", _b10_sql())
def b10_sum_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = with_parsed(fx.fx_quantity(spark, sf_dir), "mem_k8s", "memory_k8s", "bytes", "reason")
    return sum_quantity(parsed, ["l_suppkey"], "bytes", "total_bytes", "n_valid")


@register("b11_scale",
          "select l_orderkey, l_linenumber, "
          f"cast({_pos('cast(trunc((cast(l_quantity as double) * 1048576.0) * l_discount) as bigint)')} as decimal(38,0)) as mem_scaled, "
          f"cast(9007199254740993::hugeint * l_linenumber as decimal(38,0)) as mem_x_line, "
          f"{_pos('cast(trunc(((cast(trunc(l_quantity * 1000.0) as bigint) / 1000.0) * 1.5) * 1000.0) as bigint)')}"
          " as cpu_x1_5, "
          f"{_pos('cast(trunc(l_quantity * 1000.0) as bigint) * 3')} as cpu_x3, "
          f"{_pos('cast(trunc(((cast(trunc(l_quantity * 1000.0) as bigint) / 1000.0) * l_tax) * 1000.0) as bigint)')}"
          " as cpu_x_tax from lineitem")
def b11_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_parquet(spark, table_path(sf_dir, "lineitem"))
    mem = q.to_bytes("l_quantity", "Mi")
    cpu = q.to_m_cores("l_quantity")
    return li.select("l_orderkey", "l_linenumber",
                     q.scale_memory(mem, F.col("l_discount")).alias("mem_scaled"),
                     q.scale_memory(F.lit(9007199254740993), F.col("l_linenumber")).alias("mem_x_line"),
                     q.scale_cpu(cpu, 1.5).alias("cpu_x1_5"),
                     q.scale_cpu(cpu, 3).alias("cpu_x3"),
                     q.scale_cpu(cpu, F.col("l_tax")).alias("cpu_x_tax"))


def _b12_sql() -> str:
    v, _ = parse_sql("memory_k8s", "mem_k8s")
    return (with_(FX_QUANTITY) +
            f"select l_orderkey, l_linenumber, mem_k8s from fx_quantity "
            f"where {v} >= 1073741824 and {v} < 41875931136")


@register("b12_where_quantity", _b12_sql())
def b12_where_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.fx_quantity(spark, sf_dir)
    df = where_quantity(df, "mem_k8s", ">=", "1Gi", "memory_k8s", also=[("<", "39Gi")])
    return df.select("l_orderkey", "l_linenumber", "mem_k8s")


def _b12_range_sql() -> str:
    v, _ = parse_sql("memory_k8s", "mem_k8s")
    return (with_(FX_QUANTITY) +
            f"select l_suppkey, cast(min({v}) as decimal(38,0)) as min_mem_k8s, cast(max({v}) as decimal(38,0)) as max_mem_k8s, count({v}) as n_valid_mem_k8s "
            "from fx_quantity group by l_suppkey")


@register("b12_quantity_range", _b12_range_sql())
def b12_quantity_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest and largest quantity per supplier across notations."""
    return quantity_range(fx.fx_quantity(spark, sf_dir), ["l_suppkey"], "mem_k8s", "memory_k8s")


def _b12_sort_sql() -> str:
    v, _ = parse_sql("memory_k8s", "mem_k8s")
    return (with_(FX_QUANTITY) + f"select l_orderkey, l_linenumber, mem_k8s from fx_quantity where {v} is not null "
            f"order by {v} desc, l_orderkey, l_linenumber limit 500")


@register("b12_sort_quantity", _b12_sort_sql())
def b12_sort_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 500 largest quantities, whatever their notation (a top-k report)."""
    ordered = sort_by_quantity(fx.fx_quantity(spark, sf_dir), "mem_k8s", "memory_k8s", ascending=False,
                               then=["l_orderkey", "l_linenumber"])
    return ordered.select("l_orderkey", "l_linenumber", "mem_k8s").limit(500)


def _b13_good_sql() -> str:
    v, r = parse_sql("cpu_k8s", "cpu_k8s")
    return (with_(FX_QUANTITY) + f"select l_orderkey, l_linenumber, cpu_k8s, {v} as cpu_k8s_value from fx_quantity where {r} is null")


@register("b13_split_valid_good", _b13_good_sql())
def b13_split_valid_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good side, checked strictly once more."""
    good, _ = split_valid(fx.fx_quantity(spark, sf_dir), "cpu_k8s", "cpu_k8s")
    strict, _ = split_valid(good.drop("cpu_k8s_value"), "cpu_k8s", "cpu_k8s", strict=True)
    return strict.select("l_orderkey", "l_linenumber", "cpu_k8s", "cpu_k8s_value")


def _b13_sql() -> str:
    _, r = parse_sql("cpu_k8s", "cpu_k8s")
    return (with_(FX_QUANTITY) +
            f"select * from (select l_orderkey, l_linenumber, cpu_k8s, {r} as reason from fx_quantity) "
            "where reason is not null")


@register("b13_split_valid", _b13_sql())
def b13_split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_valid(fx.fx_quantity(spark, sf_dir), "cpu_k8s", "cpu_k8s")
    return bad.select("l_orderkey", "l_linenumber", "cpu_k8s", F.col("cpu_k8s_reason").alias("reason"))


def _b13_both_sql() -> str:
    v, r = parse_sql("cpu_k8s", "cpu_k8s")
    return (with_(FX_QUANTITY) + f"select l_orderkey, l_linenumber, cpu_k8s, case when {r} is null then {v} end as cpu_k8s_value, "
            f"{r} as cpu_k8s_reason from fx_quantity")


@register("b13_write_valid", _b13_both_sql())
def b13_write_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides stored by one parse and one write, and read back together."""
    root = scratch_dir(spark, "b13")
    q13 = fx.fx_quantity(spark, sf_dir).select("l_orderkey", "l_linenumber", "cpu_k8s")
    good, bad = write_valid(q13, "cpu_k8s", "cpu_k8s", f"{root}/good", f"{root}/bad")
    return good.unionByName(bad, allowMissingColumns=True)


# --------------------------------------------------------------------------
# Tier B: settings
# --------------------------------------------------------------------------

def _fleet_names() -> tuple:
    return (F.concat(F.lit("fleet_"), F.col("deploy_mode")),
            F.concat(F.lit("task_"), F.col("task_id").cast("string")))


@register("b14_request_memory", osql.b14_sql())
def b14_request_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_memory(fx.fx_fleet(spark, sf_dir)).select("task_id", "request_memory", "request_memory_text")


@register("b15_requests_rollup", osql.b15_sql())
def b15_requests_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_rollup(request_memory(fx.fx_fleet(spark, sf_dir)), ["owner_id", "deploy_mode"])


@register("b16_render_conf", osql.b16_sql())
def b16_render_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet, env = fx.fx_fleet(spark, sf_dir), fx.fleet_env()
    return st.pair_rows(fleet, st.conf_pairs(fleet, "driver", env) + st.conf_pairs(fleet, "executor", env))


@register("b17_mode_keys", osql.b17_sql())
def b17_mode_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.render_conf(fx.fx_fleet(spark, sf_dir), "base", fx.fleet_env())


@register("b18_resolve_layers", osql.b18_sql())
def b18_resolve_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fleet's layers resolved inside each row (one small join of the
    per-task overrides); equal to :func:`resolve_layers` on the long table."""
    dag, task = _fleet_names()
    return st.fleet_conf(fx.fx_fleet(spark, sf_dir), fx.fx_override(spark, sf_dir), fx.fleet_env(), dag, task)


@register("b18_resolve_layers_long", osql.b18_sql())
def b18_resolve_layers_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B18 by the generic long-table resolution, over every rendered key; tasks and their overrides are
    dealt out by task before they are rendered."""
    fleet, env = st.by_task(fx.fx_fleet(spark, sf_dir)), fx.fleet_env()
    rendered = st.pair_rows(fleet, st.name_pairs(*_fleet_names()) + st.conf_pairs(fleet, "base", env)
                            + st.conf_pairs(fleet, "driver", env) + st.conf_pairs(fleet, "executor", env))
    extra = st.by_task(fx.fx_override(spark, sf_dir)).join(fleet.select("task_id"), "task_id", "left_semi").select(
        "task_id", F.lit(st.LAYERS["extra"]).alias("layer"), F.col("n").cast("int").alias("ord"), "key", "value")
    return st.resolve_layers(rendered.unionByName(extra))


@register("b19_apply_defaults", osql.b19_sql())
def b19_apply_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.apply_defaults(fx.fx_fleet(spark, sf_dir), "executor", fx.fleet_env())


@register("b19_lookup",
          "with f as (select o_orderkey as task_id, case when o_orderkey % 50 <> 0 then 'ns-' || (o_orderkey % 25) end as ns, "
          "case when o_orderkey % 4 <> 0 then '__AUTODETECT__' else 'own' end as sa from orders), "
          "t as (select case when n_nationkey <> 7 then 'ns-' || n_nationkey end as ns, 'sa-' || lower(n_name) as found_sa, "
          "case when n_nationkey % 3 <> 0 then 'arn:ns-' || n_nationkey end as found_arn from nation where n_nationkey < 20) "
          "select task_id, case when sa <> '__AUTODETECT__' then sa when found_sa is not null then found_sa else 'airflow-worker' end "
          "as service_account_name, case when found_sa is not null then found_arn else 'default' end as aws_role_arn "
          "from f left join t on f.ns is not distinct from t.ns")
def b19_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B19 with sentinel values from a table, by namespace: some namespaces are missing, one is null."""
    fleet, lookup = fx.fx_namespaces(spark, sf_dir)
    fleet, env = st.with_lookup(fleet, lookup, ["namespace"], fx.fleet_env())
    return st.apply_defaults(fleet, "executor", env).select("task_id", "service_account_name", "aws_role_arn")


@register("b20_conf_text", osql.b20_sql())
def b20_conf_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    dag, task = _fleet_names()
    return st.fleet_conf_text(fx.fx_fleet(spark, sf_dir), fx.fx_override(spark, sf_dir), fx.fleet_env(),
                              dag, task)


@register("b20_conf_text_long", osql.b20_sql())
def b20_conf_text_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B20 by the generic long table."""
    return st.conf_text(b18_resolve_layers_long(spark, sf_dir))


@register("b26_slug", osql.b26_sql())
def b26_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_parquet(spark, table_path(sf_dir, "orders"))
    task = F.concat(F.lit("Order #"), F.col("o_orderkey").cast("string"), F.lit(" - "),
                    F.col("o_orderstatus"), F.lit("'s"))
    return o.select(F.col("o_orderkey").alias("task_id"), slug("o_orderpriority", task).alias("app_name"))


# --------------------------------------------------------------------------
# Tier B: placement and documents
# --------------------------------------------------------------------------

def _fleet_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 13th task brings its own labels."""
    fleet = fx.fx_fleet(spark, sf_dir)
    own = F.when(F.col("task_id") % 13 == 0,
                 F.create_map(F.lit("team"), F.concat(F.lit("owner-"), F.col("owner_id").cast("string"))))
    return fleet.withColumn("labels", own)


def _drivers_with_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 9th task brings its own rules."""
    own = F.array(F.struct(F.lit(90), F.lit(DRIVER_LABEL), affinity_id("driver", "task_id"), F.lit(HOST)),
                  F.struct(F.lit(15), F.lit(EXECUTOR_LABEL), affinity_id("executor", "task_id"), F.lit(ZONE))).cast(ArrayType(RULE))
    return fx.fx_driver(spark, sf_dir).withColumn("rules", F.when(F.col("task_id") % 9 == 0, own))


@register("b21_placement_rules", odoc.b21_sql())
def b21_placement_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placement_rules(_drivers_with_rules(spark, sf_dir), own="rules")


@register("b22_rank_placements", odoc.b22_sql())
def b22_rank_placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    drivers = _drivers_with_rules(spark, sf_dir)
    return rank_placements(drivers, fx.fx_executor(spark, sf_dir), fx.fx_node(spark, sf_dir),
                           rules=placement_rules(drivers, own="rules"))


@register("b23_render_pod_json", odoc.b23_sql())
def b23_render_pod_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_pod_json(_fleet_with_labels(spark, sf_dir), "executor", fx.fleet_env(), labels="labels")


@register("b23_render_pod_json_driver", odoc.b23_driver_sql())
def b23_render_pod_json_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B23 for the driver: downward-API environment, no generated affinity."""
    return render_pod_json(_fleet_with_labels(spark, sf_dir), "driver", fx.fleet_env(), labels="labels")


@register("b24_pod_labels", odoc.b24_sql())
def b24_pod_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet = _fleet_with_labels(spark, sf_dir)
    return fleet.select("task_id", F.explode(pod_labels("task_id", "executor", F.col("labels")))
                        .alias("label_key", "label_value"))


@register("b25_token_claims", odoc.b25_sql())
def b25_token_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_per_account(fx.fx_token(spark, sf_dir))

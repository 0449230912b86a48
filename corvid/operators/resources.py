"""Resource requests of task configurations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corvid.functions.quantity import WIDE, format_cpu_k8s, format_memory_k8s, scale_memory
from corvid.operators.aggregate import col_of


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def request_memory_bytes(memory: Column | str, overhead: Column | str, factor: Column | str,
                         rule: str = "as_coded") -> Column:
    """Memory a task requests, in bytes.

    Null when memory is null; else memory + overhead when an overhead is set;
    else, when a factor is set, memory x factor (``as_coded``, what the
    reference computes although it calls the factor *additional* memory) or
    memory x (1 + factor) (``additional``); else memory. A product that
    truncates to zero or less is null.
    """
    if rule not in ("as_coded", "additional"):
        raise ValueError("rule is 'as_coded' or 'additional'")
    m, o, f = _col(memory).cast(WIDE), _col(overhead).cast(WIDE), _col(factor).cast("double")
    scaled = scale_memory(m, f if rule == "as_coded" else F.lit(1.0) + f, integral=False)
    return (F.when(m.isNull(), F.lit(None).cast(WIDE))
            .when(o.isNotNull(), (m + o).cast(WIDE))
            .when(f.isNotNull(), scaled)
            .otherwise(m))


def request_memory(df: DataFrame, memory: str = "memory", overhead: str = "memory_overhead",
                   factor: str = "memory_overhead_factor", rule: str = "as_coded",
                   name: str = "request_memory") -> DataFrame:
    """B14 on a table: adds ``<name>`` (bytes) and ``<name>_text`` (``Mi`` text)."""
    df = df.withColumn(name, request_memory_bytes(col_of(df, memory), col_of(df, overhead), col_of(df, factor), rule))
    return df.withColumn(f"{name}_text", format_memory_k8s(col_of(df, name), "Mi"))


def requests_rollup(df: DataFrame, keys: Sequence[str], cpu: str = "request_cores",
                    memory: str = "request_memory") -> DataFrame:
    """Per row, requests are the CPU and memory that are set and the limit
    is the memory; totals per key (exact ``decimal(38,0)``), plus how many
    tasks set each. One partial + final aggregate."""
    c, m = col_of(df, cpu).cast("decimal(38,0)"), col_of(df, memory).cast("decimal(38,0)")
    return df.groupBy(*[col_of(df, k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.sum(c).alias("requests_cpu_m"),
        F.sum(m).alias("requests_memory_bytes"),
        F.sum(m).alias("limits_memory_bytes"),
        F.count(c).alias("n_cpu_requests"),
        F.count(m).alias("n_memory_requests"),
    )


def container_resources(cpu: Column | str, memory: Column | str) -> Column:
    """Requests and limits of one container as a struct of texts. Requests
    hold what is set; the limit is the memory; an empty part is null and so
    dropped by ``to_json`` (the struct itself stays, possibly as ``{}``)."""
    c, m = _col(cpu), _col(memory)
    return F.struct(
        F.when(m.isNotNull(), F.struct(format_memory_k8s(m, "Mi").alias("memory"))).alias("limits"),
        F.when(c.isNotNull() | m.isNotNull(),
               F.struct(format_cpu_k8s(c).alias("cpu"), format_memory_k8s(m, "Mi").alias("memory")))
        .alias("requests"),
    )

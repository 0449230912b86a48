"""DuckDB SQL twins of the fixtures and of the quantity grammars, used to
write the oracle queries in :mod:`corvid.plans.catalog`.

Only the base tables exist in DuckDB, so fixtures are inlined as CTEs.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): unit names and multipliers.
K8S_UNITS = {"Ei": 1152921504606846976, "Pi": 1125899906842624, "Ti": 1099511627776, "Gi": 1073741824, "Mi": 1048576,
             "Ki": 1024, "E": 1000000000000000000, "P": 1000000000000000, "T": 1000000000000, "G": 1000000000,
             "M": 1000000, "k": 1000}
JVM_UNITS = {"t": 1099511627776, "g": 1073741824, "m": 1048576, "k": 1024}
# ---------------------------------------------------------------------------

FX_QUANTITY = """fx_quantity as (
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case l_partkey % 20 when 17 then null when 18 then '' when 19 then '0Gi' else q ||
    case l_partkey % 20 when 0 then 'Mi' when 1 then 'Gi' when 2 then 'Ki' when 3 then '' when 4 then 'M' when 5 then 'k'
      when 6 then '.5Gi' when 7 then 'G' when 8 then 'bad' when 9 then 'Ti' when 10 then 'Pi' when 11 then 'Ei' when 12 then 'T'
      when 13 then 'P' when 14 then 'E' when 15 then '000Ei' when 16 then ' Mi' end end as mem_k8s,
  case l_partkey % 10 when 8 then null when 9 then '0m' else q ||
    case l_partkey % 10 when 0 then 'k' when 1 then 'm' when 2 then 'g' when 3 then 't' when 4 then '' when 5 then '0000000t'
      when 6 then '00000000000000000000000000000000000000k' else 'G' end end as mem_jvm,
  case l_partkey % 9 when 0 then q || '00m' when 1 then q when 2 then '0.' || q when 3 then q || '.001' when 4 then '0.0001'
    when 5 then q || '000000000000000000000' when 6 then '' when 7 then null else 'x' end as cpu_k8s
from (select *, cast(cast(l_quantity as int) as varchar) as q from lineitem))"""

FX_TASK_CONF = """fx_task_conf as (
select o_orderkey as task_id, o_custkey as owner_id,
  case o_orderstatus when 'F' then 'local' when 'O' then 'client' else 'connect' end as deploy_mode,
  cast(case when o_orderkey % 11 = 0 then null else 512*(1+o_orderkey % 16) end as bigint) as memory_mib,
  cast(case when o_orderkey % 3 = 0 then 128*(1+o_orderkey % 4) end as bigint) as overhead_mib,
  cast(case when o_orderkey % 8 = 5 then 0.0005 when o_orderkey % 4 = 1 then 0.1*(1+o_orderkey % 3) end as double) as overhead_factor,
  cast(250*(1+o_custkey % 8) as bigint) as request_m_cores,
  case when o_orderkey % 5 = 0 then null else cast(1+o_orderkey % 6 as int) end as instances
from orders)"""

FX_NODE = "fx_node as (select 'node-' || s_suppkey as node, 'zone-' || s_nationkey as zone from supplier)"
FX_DRIVER = ("fx_driver as (select c_custkey as task_id, 'node-' || (c_custkey % (select count(*) from supplier)) as node "
             "from customer)")
FX_EXECUTOR = ("fx_executor as (select o_orderkey as pod_id, o_custkey as task_id, "
               "'node-' || ((o_orderkey*7) % (select count(*) + 3 from supplier)) as node from orders)")

FX_OVERRIDE = """fx_override as (
select task_id, 0 as n, 'spark.shuffle.file.buffer' as key, '4m' as value from fx_task_conf where task_id % 7 = 0
union all select task_id, 1, 'spark.executor.extraLibraryPath', null from fx_task_conf where task_id % 7 = 0
union all select task_id, 2, 'spark.eventLog.enabled', 'true' from fx_task_conf where task_id % 14 = 0
union all select task_id, 3, 'spark.jars.packages', null from fx_task_conf where task_id % 21 = 0
union all select task_id, 4, 'spark.extra.k' || (task_id % 1500), 'x' from fx_task_conf where task_id % 7 = 0
union all select task_id, 5, 'spark.eventLog.enabled', 'false' from fx_task_conf where task_id % 14 = 0
union all select -task_id - 1, 6, 'spark.driver.memory', '9g' from fx_task_conf where task_id % 35 = 0)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _unit_case(unit: str, table: dict[str, int]) -> str:
    whens = " ".join(f"when '{k}' then {v}" for k, v in table.items())
    return f"case {unit} when '' then 1 {whens} end"


def _reason(src: str, ok: str, value: str) -> str:
    return (f"case when {src} is null then 'type' when not {ok} then 'pattern' "
            f"when {value} is null then 'range' when {value} <= 0 then 'not_positive' end")


def _dbl_to_long(d: str) -> str:
    return f"case when {d} < 9.223372036854775807e18 then cast(trunc({d}) as bigint) end"


#: Fixed values (must equal the reference's): the number grammars.
NUMBER = r"(\d+\.?\d*|\d*\.?\d+)"
INTEGER_TEXT = r"^\s*([+-]?\d+(?:_\d+)*)\s*$"


def parse_sql(kind: str, src: str) -> tuple[str, str]:
    """(value, reason) SQL expressions of a parser applied to column ``src``;
    memory values are hugeints, to be cast to decimal(38,0) where stored."""
    if kind == "memory_k8s":
        pat = rf"^{NUMBER}({'|'.join(K8S_UNITS)})?$"
        ok = f"regexp_matches({src}, '{pat}')"
        d = (f"(try_cast(regexp_extract({src}, '{pat}', 1) as double) * "
             f"{_unit_case(f'regexp_extract({src}, {chr(39)}{pat}{chr(39)}, 2)', K8S_UNITS)})")
        v = f"case when {d} < 1e38 then cast(trunc({d}) as hugeint) end"
    elif kind == "memory_jvm":
        pat = rf"^(\d+)({'|'.join(JVM_UNITS)})?$"
        ok = f"regexp_matches({src}, '{pat}')"
        n = f"try_cast(regexp_extract({src}, '{pat}', 1) as hugeint)"
        u = f"cast({_unit_case(f'regexp_extract({src}, {chr(39)}{pat}{chr(39)}, 2)', JVM_UNITS)} as hugeint)"
        v = f"case when {n} <= 99999999999999999999999999999999999999::hugeint // {u} then {n} * {u} end"
    elif kind == "cpu_k8s":
        pat = rf"^{NUMBER}(m?)$"
        ok = f"regexp_matches({src}, '{pat}')"
        num = f"try_cast(regexp_extract({src}, '{pat}', 1) as double)"
        d = f"(case when regexp_extract({src}, '{pat}', 2) = 'm' then {num} else {num} * 1000.0 end)"
        v = _dbl_to_long(d)
    elif kind == "cpu_jvm":
        pat = INTEGER_TEXT
        ok = f"regexp_matches({src}, '{pat}')"
        h = f"(try_cast(replace(regexp_extract({src}, '{pat}', 1), '_', '') as hugeint) * 1000)"
        v = (f"case when {h} between -9223372036854775808 and 9223372036854775807 "
             f"then cast({h} as bigint) end")
    else:
        raise ValueError(kind)
    value = f"case when {ok} and ({v}) > 0 then {v} end"
    return value, _reason(src, ok, v)

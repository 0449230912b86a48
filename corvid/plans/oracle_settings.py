"""DuckDB SQL twins of the settings jobs (B14-B20, B26). Keys, order, formats
and defaults are written out here once more, not taken from the Spark jobs, so
that a wrong one there shows."""

from __future__ import annotations

from corvid.plans.oracle import FX_OVERRIDE, FX_TASK_CONF

FX_FLEET = """fx_fleet as (
select task_id, owner_id, deploy_mode, memory_mib * 1048576 as memory, overhead_mib * 1048576 as memory_overhead,
  overhead_factor as memory_overhead_factor, request_m_cores as request_cores, instances,
  cast(case when task_id % 10 <> 7 then 2147483648 * (1 + task_id % 3) end as bigint) as driver_memory,
  cast(500 * (1 + task_id % 4) as bigint) as driver_request_cores,
  case when task_id % 13 = 0 then '' when task_id % 17 = 0 then 'k8s://other:443' end as spark_url,
  task_id % 10 = 3 as driver_memory_unset, task_id % 15 = 0 as instances_unset
from fx_task_conf)"""
CTES = [FX_TASK_CONF, FX_FLEET]

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): keys, their order and defaults.
# (place, key, value); null values are not set.
_MIB = "cast(({}) // 1048576 as varchar) || 'm'"
BASE = [
    (0, "case when deploy_mode = 'connect' then 'spark.remote' else 'spark.master' end",
     "coalesce(nullif(spark_url, ''), case deploy_mode when 'local' then 'local[*]' when 'client' then "
     "'k8s://https://kubernetes.default.svc.cluster.local:443' when 'connect' then "
     "'sc://spark-connect.spark-connect.svc.cluster.local:15002' end)"),
    (1, "'spark.submit.deployMode'", "case when deploy_mode = 'client' then 'client' end"),
    (2, "'spark.kubernetes.namespace'", "'team-a'"),
    (3, "'spark.kubernetes.authenticate.submission.caCertFile'", "'/var/run/secrets/kubernetes.io/serviceaccount/ca.crt'"),
    (4, "'spark.kubernetes.authenticate.submission.oauthTokenFile'", "'/var/run/secrets/kubernetes.io/serviceaccount/token'"),
    (5, "'spark.shuffle.file.buffer'", "'1m'"),
    (6, "'spark.kubernetes.container.image.pullPolicy'", "'IfNotPresent'"),
    (7, "'spark.kubernetes.container.image.pullSecrets'", "null"),
    (8, "'spark.jars.packages'", "null"),
]
DRIVER = [
    (2, "'spark.driver.cores'", "null"),
    (3, "'spark.kubernetes.driver.request.cores'", "cast(driver_request_cores as varchar) || 'm'"),
    (4, "'spark.driver.memory'", _MIB.format("case when driver_memory_unset then 1073741824 else driver_memory end")),
    (5, "'spark.driver.memoryOverhead'", _MIB.format("memory_overhead")),
    (6, "'spark.driver.memoryOverheadFactor'", "cast(memory_overhead_factor as varchar)"),
    (7, "'spark.kubernetes.driver.container.image'", "'apache/spark:3.5.0-scala2.12-java17-python3-ubuntu'"),
    (8, "'spark.kubernetes.driver.podTemplateContainerName'", "'base'"),
    (9, "'spark.kubernetes.authenticate.driver.serviceAccountName'", "'airflow-worker'"),
    (10, "'spark.kubernetes.driver.annotation.eks.amazonaws.com/role-arn'", "'default'"),
    (11, "'spark.driver.extraJavaOptions'", "'-XX:+ExitOnOutOfMemoryError'"),
    (12, "'spark.driver.extraClassPath'", "'/opt/spark/jars/*'"),
    (13, "'spark.driver.extraLibraryPath'", "'/opt/hadoop/lib/native'"),
    (14, "'spark.kubernetes.driver.pod.name'", "'worker-' || cast(task_id as varchar)"),
    (15, "'spark.driver.host'", "'10.0.0.1'"),
]
EXECUTOR = [
    (2, "'spark.executor.cores'", "null"),
    (3, "'spark.kubernetes.executor.request.cores'", "cast(request_cores as varchar) || 'm'"),
    (4, "'spark.executor.memory'", _MIB.format("memory")),
    (5, "'spark.executor.memoryOverhead'", _MIB.format("memory_overhead")),
    (6, "'spark.executor.memoryOverheadFactor'", "cast(memory_overhead_factor as varchar)"),
    (7, "'spark.kubernetes.executor.container.image'", "'spark:3.5.0-scala2.12-java17-python3-ubuntu'"),
    (8, "'spark.kubernetes.executor.podTemplateContainerName'", "'spark'"),
    (9, "'spark.kubernetes.authenticate.executor.serviceAccountName'", "'airflow-worker'"),
    (10, "'spark.kubernetes.executor.annotation.eks.amazonaws.com/role-arn'", "'default'"),
    (11, "'spark.executor.extraJavaOptions'", "'-XX:+ExitOnOutOfMemoryError'"),
    (12, "'spark.executor.extraClassPath'", "'/opt/spark/jars/*'"),
    (13, "'spark.executor.extraLibraryPath'", "'/opt/hadoop/lib/native'"),
    (14, "'spark.executor.instances'", "cast(case when instances_unset then 1 else instances end as varchar)"),
    (15, "'spark.dynamicAllocation.enabled'", "null"),
    (16, "'spark.dynamicAllocation.minExecutors'", "null"),
    (17, "'spark.dynamicAllocation.maxExecutors'", "null"),
    (18, "'spark.kubernetes.executor.podTemplateFile'", "'/tmp/executor_pod_template.yaml'"),
]
# ---------------------------------------------------------------------------
COMPONENTS = {"base": (1, BASE), "driver": (2, DRIVER), "executor": (3, EXECUTOR)}


def rendered_sql(*components: str) -> str:
    parts = [f"select task_id, {layer} as layer, {place} as ord, {key} as key, {value} as value from fx_fleet"
             for layer, rows in (COMPONENTS[c] for c in components) for place, key, value in rows]
    return "select * from (" + "\nunion all ".join(parts) + ") where value is not null"


def slug_sql(*parts: str) -> str:
    joined = "lower(concat_ws('-', " + ", ".join(f"nullif({p}, '')" for p in parts) + "))"
    s = f"replace({joined}, '''', '')"
    s = f"regexp_replace({s}, '([0-9]),([0-9])', '\\1\\2', 'g')"
    s = f"regexp_replace({s}, '[^a-z0-9]+', '-', 'g')"
    return f"regexp_replace({s}, '^-+|-+$', '', 'g')"


FLEET_DAG_SQL = "'fleet_' || deploy_mode"
FLEET_TASK_SQL = "'task_' || cast(task_id as varchar)"


def layers_sql() -> str:
    """All layers of every task as long rows: name, base, driver, executor
    (nulls dropped) and extra (nulls kept: they delete)."""
    name = (f"select task_id, 0 as layer, 0 as ord, 'spark.app.name' as key, "
            f"{slug_sql(FLEET_DAG_SQL, FLEET_TASK_SQL)} as value from fx_fleet")
    extra = ("select task_id, 4, n, key, value from (select *, row_number() over (partition by task_id, key order by n desc) as r "
             "from fx_override) where r = 1 and task_id in (select task_id from fx_fleet)")
    return f"{name}\nunion all {rendered_sql('base', 'driver', 'executor')}\nunion all {extra}"


def resolved_sql() -> str:
    return f"""resolved as (
select task_id, first_layer as layer, first_ord as ord, key, value from (
  select task_id, key,
    first_value(value) over (partition by task_id, key order by layer desc) as value,
    first_value(layer) over (partition by task_id, key order by layer, ord) as first_layer,
    first_value(ord) over (partition by task_id, key order by layer, ord) as first_ord,
    row_number() over (partition by task_id, key order by layer desc) as rn
  from ({layers_sql()}) l)
where rn = 1 and value is not null)"""


def with_settings(*extra_ctes: str) -> str:
    return "with " + ",\n".join([*CTES, *extra_ctes]) + "\n"


B14_BODY = """select task_id,
  cast(case when memory is null then null
       when memory_overhead is not null then memory + memory_overhead
       when memory_overhead_factor is not null then
         case when trunc(cast(memory as double) * memory_overhead_factor) >= 1
              then cast(trunc(cast(memory as double) * memory_overhead_factor) as hugeint) end
       else memory end as decimal(38,0)) as request_memory
from fx_fleet"""


def b14_sql() -> str:
    return (with_settings(f"r as ({B14_BODY})") +
            "select task_id, request_memory, cast(request_memory::hugeint // 1048576 as varchar) || 'Mi' "
            "as request_memory_text from r")


def b15_sql() -> str:
    return (with_settings(f"r as (select f.owner_id, f.deploy_mode, f.request_cores, x.request_memory from "
                          f"fx_fleet f join ({B14_BODY}) x using (task_id))") +
            "select owner_id, deploy_mode, count(*) as n_tasks, "
            "sum(cast(request_cores as decimal(38,0))) as requests_cpu_m, "
            "sum(cast(request_memory as decimal(38,0))) as requests_memory_bytes, "
            "sum(cast(request_memory as decimal(38,0))) as limits_memory_bytes, "
            "count(request_cores) as n_cpu_requests, count(request_memory) as n_memory_requests "
            "from r group by owner_id, deploy_mode")


def b16_sql() -> str:
    return with_settings() + rendered_sql("driver", "executor")


def b17_sql() -> str:
    return with_settings() + rendered_sql("base")


def b18_sql() -> str:
    return with_settings(FX_OVERRIDE, resolved_sql()) + "select * from resolved"


def b19_sql() -> str:
    cols = """null::bigint as cores, request_cores, cast(memory as decimal(38,0)) as memory,
  cast(memory_overhead as decimal(38,0)) as memory_overhead, memory_overhead_factor,
  'spark:3.5.0-scala2.12-java17-python3-ubuntu' as image, 'spark' as container_name, 'airflow-worker' as service_account_name,
  'default' as aws_role_arn, '-XX:+ExitOnOutOfMemoryError' as extra_java_options, '/opt/spark/jars/*' as extra_class_path,
  '/opt/hadoop/lib/native' as extra_library_path, case when instances_unset then 1::integer else instances end as instances,
  null::boolean as dynamic_allocation_enabled, null::integer as dynamic_allocation_min_executors,
  null::varchar as dynamic_allocation_max_executors"""
    return with_settings() + f"select task_id, {cols} from fx_fleet"


def b20_sql() -> str:
    return (with_settings(FX_OVERRIDE, resolved_sql()) +
            "select task_id, string_agg(key || '=' || value, chr(10) order by layer, ord) "
            "as conf_text from resolved group by task_id")


def b26_sql() -> str:
    dag = "o_orderpriority"
    task = "'Order #' || cast(o_orderkey as varchar) || ' - ' || o_orderstatus || '''s'"
    return f"select o_orderkey as task_id, {slug_sql(dag, task)} as app_name from orders"

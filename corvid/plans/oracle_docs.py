"""DuckDB SQL twins of the placement and document jobs (B21-B25). B22's twin
is the brute force: it scores every task against every node."""

from __future__ import annotations

from corvid.plans.oracle import FX_DRIVER, FX_EXECUTOR, FX_NODE, FX_TASK_CONF, with_
from corvid.plans.oracle_settings import B14_BODY, FX_FLEET


# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): labels, rules, downward-API
# environment and images.
LABEL = {"driver": "spark-driver-affinity-id", "executor": "spark-executor-affinity-id"}
RULES = [(100, "driver", "kubernetes.io/hostname"), (75, "executor", "kubernetes.io/hostname"),
         (50, "driver", "topology.kubernetes.io/zone"), (25, "executor", "topology.kubernetes.io/zone")]
DRIVER_ENV = [("SPARK_DRIVER_POD_NAME", "metadata.name"), ("SPARK_DRIVER_POD_IP", "status.podIP"),
              ("SPARK_DRIVER_AFFINITY_ID", "metadata.labels['spark-driver-affinity-id']")]
EXECUTOR_IMAGE = "spark:3.5.0-scala2.12-java17-python3-ubuntu"
# ---------------------------------------------------------------------------
# Ours: the driver's default image.
DRIVER_IMAGE = "apache/spark:3.5.0-scala2.12-java17-python3-ubuntu"


def uuid_sql(component: str, task: str = "task_id") -> str:
    h = f"sha256('{component}:' || cast({task} as varchar))"
    return (f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
            f"substr({h}, 17, 4), substr({h}, 21, 12))")


def b21_sql() -> str:
    parts = [f"select task_id, {w} as weight, '{LABEL[who]}' as label_key, {uuid_sql(who)} as label_value, "
             f"'{topo}' as topology_key from fx_driver where task_id % 9 <> 0" for w, who, topo in RULES]
    own = [f"select task_id, {w} as weight, '{LABEL[who]}' as label_key, {uuid_sql(who)} as label_value, "
           f"'{topo}' as topology_key from fx_driver where task_id % 9 = 0"
           for w, who, topo in ((90, "driver", RULES[0][2]), (15, "executor", RULES[2][2]))]
    return with_(FX_DRIVER) + "\nunion all ".join(parts + own)


def b22_sql() -> str:
    return with_(FX_NODE, FX_DRIVER, FX_EXECUTOR, """
d as (select x.task_id, x.node, n.zone from fx_driver x join fx_node n using (node)),
s as (select x.task_id, x.node, n.zone from fx_executor x join fx_node n using (node)),
tasks as (select task_id from fx_driver union select task_id from fx_executor),
dh as (select distinct task_id, node from d), sh as (select distinct task_id, node from s),
dz as (select distinct task_id, zone from d), sz as (select distinct task_id, zone from s),
ruled as (select task_id, task_id % 9 = 0 as own from fx_driver),
scored as (
  select t.task_id, n.node,
    case when own then 90 else 100 end * (dh.task_id is not null)::int + case when own then 0 else 75 end * (sh.task_id is not null)::int
    + case when own then 0 else 50 end * (dz.task_id is not null)::int + case when own then 15 else 25 end * (sz.task_id is not null)::int as score
  from ruled t cross join fx_node n
  left join dh on dh.task_id = t.task_id and dh.node = n.node
  left join sh on sh.task_id = t.task_id and sh.node = n.node
  left join dz on dz.task_id = t.task_id and dz.zone = n.zone
  left join sz on sz.task_id = t.task_id and sz.zone = n.zone),
best as (select * from (select *, row_number() over (partition by task_id order by score desc, node) as rn
  from scored where score > 0) where rn = 1),
lost as (select task_id, count(*) as unlisted_pods from (select task_id, node from fx_driver union all select task_id, node from fx_executor)
  where node not in (select node from fx_node) group by 1)""") + """
select t.task_id, best.node, coalesce(best.score, 0)::integer as score, coalesce(lost.unlisted_pods, 0) as unlisted_pods
from tasks t left join best using (task_id) left join lost using (task_id)"""


OWN_LABELS_SQL = "case when task_id % 13 = 0 then 'owner-' || cast(owner_id as varchar) end"


def b23_sql() -> str:
    terms = ", ".join(
        f"json_object('podAffinityTerm', json_object('labelSelector', json_object('matchExpressions', "
        f"json_array(json_object('key', '{LABEL[who]}', 'operator', 'In', 'values', json_array({uuid_sql(who)})))), "
        f"'topologyKey', '{topo}'), 'weight', {w})" for w, who, topo in RULES)
    mem = "cast(rm::hugeint // 1048576 as varchar) || 'Mi'"
    cpu = "cast(request_cores as varchar) || 'm'"
    resources = (f"case when rm is null then json_object('requests', json_object('cpu', {cpu})) "
                 f"else json_object('limits', json_object('memory', {mem}), 'requests', "
                 f"json_object('cpu', {cpu}, 'memory', {mem})) end")
    labels = (f"case when task_id % 13 = 0 then json_object('team', {OWN_LABELS_SQL}) "
              f"else json_object('{LABEL['executor']}', {uuid_sql('executor')}) end")
    doc = (f"json_object('apiVersion', 'v1', 'kind', 'Pod', 'metadata', json_object('labels', {labels}), "
           f"'spec', json_object('affinity', json_object('podAffinity', json_object("
           f"'preferredDuringSchedulingIgnoredDuringExecution', json_array({terms}))), "
           f"'containers', json_array(json_object('image', '{EXECUTOR_IMAGE}', 'name', 'spark', "
           f"'resources', {resources})), "
           f"'dnsConfig', json_object('options', json_array(json_object('name', 'ndots', 'value', '2')))))")
    return (with_(FX_TASK_CONF, FX_FLEET, f"r as ({B14_BODY})") +
            f"select f.task_id, cast({doc} as varchar) as pod_json from fx_fleet f join "
            f"(select task_id, request_memory as rm from r) x using (task_id)")


def b23_driver_sql() -> str:
    mem = "cast(rm::hugeint // 1048576 as varchar) || 'Mi'"
    cpu = "cast(driver_request_cores as varchar) || 'm'"
    resources = (f"case when rm is null then json_object('requests', json_object('cpu', {cpu})) "
                 f"else json_object('limits', json_object('memory', {mem}), 'requests', "
                 f"json_object('cpu', {cpu}, 'memory', {mem})) end")
    env = ", ".join(f"json_object('name', '{n}', 'valueFrom', json_object('fieldRef', "
                    f"json_object('fieldPath', '{path.replace(chr(39), chr(39) * 2)}')))" for n, path in DRIVER_ENV)
    labels = (f"case when task_id % 13 = 0 then json_object('team', {OWN_LABELS_SQL}) "
              f"else json_object('{LABEL['driver']}', {uuid_sql('driver')}) end")
    doc = (f"json_object('apiVersion', 'v1', 'kind', 'Pod', 'metadata', json_object('labels', {labels}), "
           f"'spec', json_object('affinity', json_object(), "
           f"'containers', json_array(json_object('env', json_array({env}), 'image', '{DRIVER_IMAGE}', "
           f"'name', 'base', 'resources', {resources})), "
           f"'dnsConfig', json_object('options', json_array(json_object('name', 'ndots', 'value', '2')))))")
    own = B14_BODY.replace("memory is", "dm is").replace("memory +", "dm +").replace("cast(memory as", "cast(dm as").replace("else memory end", "else dm end")
    return (with_(FX_TASK_CONF, FX_FLEET, "own as (select *, case when driver_memory_unset then 1073741824 else driver_memory end as dm from fx_fleet)",
                  f"r as ({own.replace('from fx_fleet', 'from own')})") +
            f"select f.task_id, cast({doc} as varchar) as pod_json from fx_fleet f join "
            f"(select task_id, request_memory as rm from r) x using (task_id)")


def b24_sql() -> str:
    return (with_(FX_TASK_CONF, FX_FLEET) +
            f"select task_id, case when task_id % 13 = 0 then 'team' else '{LABEL['executor']}' end as label_key, "
            f"case when task_id % 13 = 0 then {OWN_LABELS_SQL} else {uuid_sql('executor')} end as label_value "
            "from fx_fleet")


def b25_sql() -> str:
    return ("select case when c_custkey % 17 = 0 then null when c_custkey % 19 = 0 then 'default' "
            "else 'sa-' || lower(c_mktsegment) end as account, count(*) as n_tokens from customer group by 1")

"""Nested documents per row: pod labels (B24), pod specifications as JSON
(B23) and service-account tokens (B25)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corvid.functions.tokens import account_claim, account_name
from corvid.operators import settings as st
from corvid.operators.aggregate import col_of
from corvid.operators.placement import DRIVER_LABEL, EXECUTOR_LABEL, affinity_id, rule_structs
from corvid.operators.resources import container_resources, request_memory_bytes

# DNS options and the driver's downward-API environment.
DNS_OPTIONS = [("ndots", "2")]
DRIVER_ENV = [("SPARK_DRIVER_POD_NAME", "metadata.name"),
              ("SPARK_DRIVER_POD_IP", "status.podIP"),
              ("SPARK_DRIVER_AFFINITY_ID", f"metadata.labels['{DRIVER_LABEL}']")]


def pod_labels(task: Column | str, component: str, own: Column | None = None) -> Column:
    """The task's own labels, else ``{<component affinity label>: id}``."""
    label = DRIVER_LABEL if component == "driver" else EXECUTOR_LABEL
    default = F.create_map(F.lit(label), affinity_id(component, task))
    return default if own is None else F.coalesce(own, default)


def _given(df: DataFrame, name: str) -> Column | None:
    """A part the table supplies itself (already in serialised form)."""
    return F.col(name) if name in df.columns else None


def _either(given: Column, default: Column) -> Column:
    """The given part when set, else the default, whatever their shapes: both
    become VARIANT values, which ``to_json`` writes out as JSON."""
    return F.coalesce(F.parse_json(F.to_json(given)), F.parse_json(F.to_json(default)))


def _affinity(df: DataFrame, task: Column, component: str) -> Column:
    """Scheduling structs; keys sorted as the serialised document has them.
    The table's own ``node_affinity``, ``pod_affinity`` and
    ``pod_anti_affinity`` are used when given; a given ``pod_affinity``
    replaces the executor's generated rules."""
    fields = []
    if _given(df, "node_affinity") is not None:
        fields.append(F.col("node_affinity").alias("nodeAffinity"))
    generated = None if component == "driver" else _generated_affinity(task)
    own = _given(df, "pod_affinity")
    if own is not None:
        generated = own if generated is None else _either(own, generated)
    fields.append((generated if generated is not None else F.lit(None).cast("string")).alias("podAffinity"))
    if _given(df, "pod_anti_affinity") is not None:
        fields.append(F.col("pod_anti_affinity").alias("podAntiAffinity"))
    return F.struct(*fields)


def _generated_affinity(task: Column) -> Column:
    terms = F.array(*[F.struct(
        F.struct(F.struct(F.array(F.struct(F.lit(key).alias("key"), F.lit("In").alias("operator"),
                                           F.array(value).alias("values"))).alias("matchExpressions"))
                 .alias("labelSelector"),
                 F.lit(topo).alias("topologyKey")).alias("podAffinityTerm"),
        F.lit(weight).alias("weight")) for weight, key, value, topo in rule_structs(task)])
    return F.struct(terms.alias("preferredDuringSchedulingIgnoredDuringExecution"))


def pod_document(df: DataFrame, component: str, env: Mapping[str, str | Column] | None = None,
                 task: str = "task_id", labels: str | None = None) -> Column:
    """The pod specification of one component as a struct with sorted
    keys; ``to_json`` of it is the document. Absent parts are dropped, empty
    objects stay (``{}``), as the cluster client serialises them.

    Parts a table may supply itself, in serialised form, and where they go:
    ``tolerations``, ``node_selector``, ``volumes`` (pod), ``node_affinity``,
    ``pod_affinity``, ``pod_anti_affinity`` (affinity), ``volume_mounts`` and
    ``environment_variables`` (container; for the driver they replace the
    downward-API defaults) and ``containers`` (replaces the rendered one).
    """
    cols = st.attribute_columns(df, component, env)
    memory = request_memory_bytes(cols["memory"], cols["memory_overhead"], cols["memory_overhead_factor"])
    container_fields = []
    env_vars = _given(df, "environment_variables")
    if component == "driver":
        default_env = F.array(*[F.struct(F.lit(n).alias("name"),
                                         F.struct(F.struct(F.lit(p).alias("fieldPath")).alias("fieldRef"))
                                         .alias("valueFrom")) for n, p in DRIVER_ENV])
        container_fields.append((default_env if env_vars is None else _either(env_vars, default_env))
                                .alias("env"))
    elif env_vars is not None:
        container_fields.append(env_vars.alias("env"))
    container_fields += [cols["image"].alias("image"), cols["container_name"].alias("name"),
                         container_resources(cols["request_cores"], memory).alias("resources")]
    if _given(df, "volume_mounts") is not None:
        container_fields.append(F.col("volume_mounts").alias("volumeMounts"))
    containers = F.array(F.struct(*container_fields))
    if _given(df, "containers") is not None:
        containers = _either(F.col("containers"), containers)
    t = col_of(df, task)
    own = col_of(df, labels) if labels else None
    spec = [_affinity(df, t, component).alias("affinity"), containers.alias("containers"),
            F.struct(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(v).alias("value"))
                               for n, v in DNS_OPTIONS]).alias("options")).alias("dnsConfig")]
    for column, key in (("node_selector", "nodeSelector"), ("tolerations", "tolerations"), ("volumes", "volumes")):
        if _given(df, column) is not None:
            spec.append(F.col(column).alias(key))
    return F.struct(
        F.lit("v1").alias("apiVersion"),
        F.lit("Pod").alias("kind"),
        F.struct(pod_labels(t, component, own).alias("labels")).alias("metadata"),
        F.struct(*spec).alias("spec"),
    )


def render_pod_json(df: DataFrame, component: str = "executor", env: Mapping[str, str | Column] | None = None,
                    task: str = "task_id", labels: str | None = None,
                    keep: Sequence[str] = ("task_id",)) -> DataFrame:
    """B23 on a table: ``keep`` columns plus ``pod_json``."""
    return df.select(*[col_of(df, k) for k in keep],
                     F.to_json(pod_document(df, component, env, task, labels)).alias("pod_json"))


def tokens_per_account(df: DataFrame, token: str = "token") -> DataFrame:
    """How many tokens name each service account (null: unreadable
    token). Signatures are not checked - an audit, not an authorisation."""
    claims = df.select(account_claim(col_of(df, token)).alias("claim"))  # parsed once
    return (claims.select(account_name(F.col("claim")).alias("account"))
            .groupBy("account").agg(F.count(F.lit(1)).alias("n_tokens")))

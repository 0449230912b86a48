"""Task settings as tables.

A fleet table holds one row per task and one column per setting, in canonical
units (bytes, milli-cores). Driver and executor settings are independent: a
column ``driver_memory`` or ``executor_memory`` holds one component's setting,
a plain ``memory`` that of every component without a column of its own. A
column that is absent takes its default; a null value means "leave this key
out"; and a row may list attributes it does not set in the array column
``unset`` (by plain or component name), which take their default in that row.
Defaults can be replaced by a mapping. The sentinel text ``__AUTODETECT__`` is
resolved from an environment mapping whose values may be literals or per-row
columns.

Rendering turns each row into key/value rows in a fixed order; layers are
then resolved with the rule "the highest layer wins; a null there deletes
the key".
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DecimalType, DoubleType, IntegerType, LongType, StringType

from corvid.functions.quantity import format_cpu_jvm, format_cpu_k8s, format_memory_jvm
from corvid.functions.text import slug
from corvid.operators.aggregate import col_of

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): keys, their order, formats and
# defaults. ``{c}`` is the component (driver or executor).
AUTODETECT = "__AUTODETECT__"
DEFAULT_K8S_MASTER = "k8s://https://kubernetes.default.svc.cluster.local:443"
DEFAULT_CONNECT_URL = "sc://spark-connect.spark-connect.svc.cluster.local:15002"
DEFAULT_LOCAL_MASTER = "local[*]"
EXECUTOR_IMAGE = "spark:3.5.0-scala2.12-java17-python3-ubuntu"
POD_TEMPLATE_PATH = "/tmp/executor_pod_template.yaml"
SA_DIR = "/var/run/secrets/kubernetes.io/serviceaccount"

# (attribute, key, format, default)
COMMON_SETTINGS = [
    ("cores", "spark.{c}.cores", "cpu_jvm", None),
    ("request_cores", "spark.kubernetes.{c}.request.cores", "cpu_k8s", 1000),
    ("memory", "spark.{c}.memory", "memory_m", 2 ** 30),
    ("memory_overhead", "spark.{c}.memoryOverhead", "memory_m", None),
    ("memory_overhead_factor", "spark.{c}.memoryOverheadFactor", "float", None),
    ("image", "spark.kubernetes.{c}.container.image", "text", None),  # per component, below
    ("container_name", "spark.kubernetes.{c}.podTemplateContainerName", "text", "spark"),
    ("service_account_name", "spark.kubernetes.authenticate.{c}.serviceAccountName", "text", "airflow-worker"),
    ("aws_role_arn", "spark.kubernetes.{c}.annotation.eks.amazonaws.com/role-arn", "text", AUTODETECT),
    ("extra_java_options", "spark.{c}.extraJavaOptions", "text", "-XX:+ExitOnOutOfMemoryError"),
    ("extra_class_path", "spark.{c}.extraClassPath", "text", "/opt/spark/jars/*"),
    ("extra_library_path", "spark.{c}.extraLibraryPath", "text", "/opt/hadoop/lib/native"),
]
DRIVER_SETTINGS = [
    ("pod_name", "spark.kubernetes.driver.pod.name", "text", AUTODETECT),
    ("host", "spark.driver.host", "text", AUTODETECT),
]
EXECUTOR_SETTINGS = [
    ("instances", "spark.executor.instances", "int", 1),
    ("dynamic_allocation_enabled", "spark.dynamicAllocation.enabled", "bool", None),
    ("dynamic_allocation_min_executors", "spark.dynamicAllocation.minExecutors", "int", None),
    ("dynamic_allocation_max_executors", "spark.dynamicAllocation.maxExecutors", "count", None),
    (None, "spark.kubernetes.executor.podTemplateFile", "const", POD_TEMPLATE_PATH),
]
BASE_SETTINGS = [
    ("kubernetes_namespace", "spark.kubernetes.namespace", "text", AUTODETECT),
    ("kubernetes_ca_cert_file", "spark.kubernetes.authenticate.submission.caCertFile", "text", f"{SA_DIR}/ca.crt"),
    ("kubernetes_oauth_token_file", "spark.kubernetes.authenticate.submission.oauthTokenFile", "text",
     f"{SA_DIR}/token"),
    ("shuffle_file_buffer", "spark.shuffle.file.buffer", "memory_m", 2 ** 20),
    ("image_pull_policy", "spark.kubernetes.container.image.pullPolicy", "text", "IfNotPresent"),
    ("image_pull_secrets", "spark.kubernetes.container.image.pullSecrets", "text", None),
    ("jars", "spark.jars.packages", "list", []),
]
# Which environment entry resolves the sentinel of each attribute.
SENTINEL_SOURCE = {
    "aws_role_arn": "aws_role_arn",
    "kubernetes_namespace": "namespace",
    "service_account_name": "service_account",
    "pod_name": "hostname",
    "host": "ip",
}
# The driver's container name is fixed; a table cannot change it.
DRIVER_CONTAINER = "base"
# Layers, lowest first.
LAYERS = {"name": 0, "base": 1, "driver": 2, "executor": 3, "extra": 4}
# ---------------------------------------------------------------------------

# Our choice, not the reference's: the driver's default image (the
# reference's names a private build).
DRIVER_IMAGE = "apache/spark:3.5.0-scala2.12-java17-python3-ubuntu"

DEFAULT_ENV: dict[str, str] = {"aws_role_arn": "default"}

_TYPES = {"cpu_jvm": LongType(), "cpu_k8s": LongType(), "memory_m": DecimalType(38, 0), "float": DoubleType(),
          "text": StringType(), "int": IntegerType(), "bool": BooleanType(), "list": ArrayType(StringType()),
          "const": StringType(), "count": StringType()}

class Pair(NamedTuple):
    """One rendered setting: its layer and place, its key (``name`` is the
    key text when it is fixed, ``None`` when it depends on the row) and value
    (null = not set)."""
    layer: int
    ord: int | Column
    name: str | None
    key: Column
    value: Column


def settings(component: str) -> list[tuple[str | None, str, str, object]]:
    """The ordered settings of ``base``, ``driver`` or ``executor``."""
    if component == "base":
        return list(BASE_SETTINGS)
    if component not in ("driver", "executor"):
        raise ValueError(component)
    rows = []
    for attr, key, fmt, default in COMMON_SETTINGS:
        if attr == "image":
            default = DRIVER_IMAGE if component == "driver" else EXECUTOR_IMAGE
        if attr == "container_name" and component == "driver":
            default = DRIVER_CONTAINER
        rows.append((attr, key.format(c=component), fmt, default))
    return rows + (DRIVER_SETTINGS if component == "driver" else EXECUTOR_SETTINGS)


def _env_value(env: Mapping[str, str | Column], name: str) -> Column:
    v = env.get(name)
    if v is None:
        return F.lit(None).cast("string")
    return v if isinstance(v, Column) else F.lit(v)


def _default_col(fmt: str, default: object) -> Column:
    if fmt == "list":
        return F.array(*[F.lit(x) for x in default]).cast(ArrayType(StringType()))
    return F.lit(default).cast(_TYPES[fmt])


UNSET = "unset"  # the array column of attributes a row does not set


def attribute_columns(df: DataFrame, component: str, env: Mapping[str, str | Column] | None = None,
                      defaults: Mapping[str, object] | None = None) -> dict[str, Column]:
    """Each attribute of ``component`` as a column.

    The component's own column (``driver_memory``) comes first, then the
    shared one (``memory``), then the default: that of ``defaults`` (by
    ``driver_memory`` or ``memory``; null = leave out), else the fixed one. A
    null value leaves the key out; an attribute that the row lists in
    ``unset`` takes its default. Sentinels are resolved from ``env``.
    """
    env, defaults = {**DEFAULT_ENV, **(env or {})}, defaults or {}
    out: dict[str, Column] = {}
    for attr, _key, fmt, default in settings(component):
        if attr is None:
            continue
        own = attr if component == "base" else f"{component}_{attr}"
        if component == "driver" and attr == "container_name":
            out[attr] = F.lit(DRIVER_CONTAINER)
            continue
        default = _default_col(fmt, defaults[own] if own in defaults else defaults.get(attr, default))
        name = next((n for n in (own, attr) if n in df.columns), None)
        col = default if name is None else F.col(f"`{name}`").cast(_TYPES[fmt])
        if name is not None and UNSET in df.columns:
            listed = F.arrays_overlap(F.col(UNSET), F.array(F.lit(own), F.lit(attr)))
            col = F.when(F.coalesce(listed, F.lit(False)), default).otherwise(col)
        if attr in SENTINEL_SOURCE:
            col = F.when(col == AUTODETECT, _env_value(env, SENTINEL_SOURCE[attr])).otherwise(col)
        out[attr] = col
    return out


def with_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[str],
                env: Mapping[str, str | Column] | None = None) -> tuple[DataFrame, dict[str, str | Column]]:
    """B19 from a table: sentinel values per key, and the environment that reads them.

    ``lookup`` has the key columns ``on`` (say, a namespace or a cluster) and columns named as entries of
    the environment (``namespace``, ``service_account``, ``aws_role_arn``, ``hostname``, ``ip``). Keys may
    be null and then meet null. A row whose key the table does not hold keeps what ``env`` gives; a null
    value in the table leaves the key out. A key that the table holds twice fails the job. The look-up is
    a plain left join: Spark broadcasts the table if it is small and splits hot keys if it is not.
    """
    names = [c for c in lookup.columns if c not in on]
    unknown = sorted(set(names) - set(SENTINEL_SOURCE.values()))
    if unknown or not names:
        raise ValueError(f"columns of the look-up table are {sorted(set(SENTINEL_SOURCE.values()))}, not {unknown}")
    once = lookup.groupBy(*[col_of(lookup, k).alias(f"__on_{k}") for k in on]).agg(
        F.max(F.struct(*[col_of(lookup, n).cast("string").alias(n) for n in names])).alias("__found"), F.count(F.lit(1)).alias("__n"))
    twice = F.raise_error(F.lit(f"the look-up table holds a key of {', '.join(on)} more than once")).cast("boolean")
    once = once.where(F.when(F.col("__n") == 1, F.lit(True)).otherwise(twice)).drop("__n")
    met = [col_of(df, k).eqNullSafe(F.col(f"__on_{k}")) for k in on]
    joined = df.join(once, reduce(Column.__and__, met), "left").drop(*[f"__on_{k}" for k in on])
    base = {**DEFAULT_ENV, **(env or {})}
    found = F.col("__found")
    return joined, {**base, **{n: F.when(found.isNotNull(), found[n]).otherwise(_env_value(base, n)) for n in names}}


def apply_defaults(df: DataFrame, component: str, env: Mapping[str, str | Column] | None = None,
                   keep: Sequence[str] = ("task_id",), defaults: Mapping[str, object] | None = None) -> DataFrame:
    """B19 on a table: ``keep`` columns plus every attribute of ``component``."""
    return df.select(*[col_of(df, k) for k in keep],
                     *[c.alias(a) for a, c in attribute_columns(df, component, env, defaults).items()])


def float_text(value: Column) -> Column:
    """A double as its shortest decimal text: plain from 1e-4 up to 1e16, else
    with an exponent of at least two digits (``0.0005``, ``1e-05``)."""
    s = value.cast("string")
    e = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).try_cast("int")
    sign = F.when(s.startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(F.regexp_replace(s, r"E.*$|[.\-]", ""), r"(?<=.)0+$", "")
    n = F.length(digits)
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    large = F.concat(sign, F.rpad(F.substring(digits, F.lit(1), e + 1), e + 1, F.lit("0")), F.lit("."),
                     F.when(n > e + 1, F.substring(digits, e + 2, n)).otherwise("0"))
    power = F.concat(F.when(e < 0, "e-").otherwise("e+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.length(F.abs(e).cast("string")), F.lit(2)), F.lit("0")))
    point = F.when(n > 1, F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, F.lit(2), n))).otherwise(digits)
    return F.when(e.isNull(), s).when((e < 0) & (e >= -4), small).when((e >= 0) & (e < 16), large).otherwise(F.concat(sign, point, power))


MAX_EXECUTORS = r"^(?:infinity|-?[0-9]+)$"


def _format(fmt: str, col: Column) -> Column:
    if fmt == "cpu_jvm":
        return format_cpu_jvm(col)
    if fmt == "cpu_k8s":
        return format_cpu_k8s(col)
    if fmt == "memory_m":
        return format_memory_jvm(col, "m")
    if fmt == "bool":
        return F.lower(col.cast("string"))
    if fmt == "float":
        return float_text(col)
    if fmt == "count":
        return F.when(col.isNull() | col.rlike(MAX_EXECUTORS), col).otherwise(
            F.raise_error(F.concat(F.lit("not a number of executors or infinity: "), col)).cast("string"))
    if fmt == "list":
        return F.when(F.size(col) > 0, F.array_join(col, ","))
    return col.cast("string")


def mode_pairs(df: DataFrame) -> list[Pair]:
    """Keys that depend on the deploy mode (``deploy_mode`` and
    ``spark_url`` columns; ``client`` when absent). An empty url is none; a
    mode outside local, client and connect fails the job."""
    mode = F.col("deploy_mode") if "deploy_mode" in df.columns else F.lit("client")
    url = F.nullif(F.col("spark_url"), F.lit("")) if "spark_url" in df.columns else F.lit(None).cast("string")
    layer = LAYERS["base"]
    unknown = F.raise_error(F.concat(F.lit("unknown deploy mode: "), F.coalesce(mode, F.lit("null")))).cast("string")
    master = (F.when(mode == "local", F.coalesce(url, F.lit(DEFAULT_LOCAL_MASTER)))
              .when(mode == "client", F.coalesce(url, F.lit(DEFAULT_K8S_MASTER)))
              .when(mode == "connect", F.coalesce(url, F.lit(DEFAULT_CONNECT_URL)))
              .otherwise(unknown))
    key = F.when(mode == "connect", F.lit("spark.remote")).otherwise(F.lit("spark.master"))
    return [Pair(layer, 0, None, key, master),
            Pair(layer, 1, "spark.submit.deployMode", F.lit("spark.submit.deployMode"),
                 F.when(mode == "client", F.lit("client")))]


def conf_pairs(df: DataFrame, component: str, env: Mapping[str, str | Column] | None = None,
               defaults: Mapping[str, object] | None = None) -> list[Pair]:
    """Rendered settings of one component as ``(layer, ord, key, value)`` in
    the reference's order; a null value means the key is left out."""
    pairs = mode_pairs(df) if component == "base" else []
    cols = attribute_columns(df, component, env, defaults)
    for i, (attr, key, fmt, default) in enumerate(settings(component), start=2):
        value = F.lit(default) if attr is None else _format(fmt, cols[attr])
        pairs.append(Pair(LAYERS[component], i, key, F.lit(key), value))
    return pairs


def name_pairs(dag_id: Column, task_name: Column) -> list[Pair]:
    """B26 as layer 0: ``spark.app.name`` from a slug of the two names."""
    return [Pair(LAYERS["name"], 0, "spark.app.name", F.lit("spark.app.name"), slug(dag_id, task_name))]


def entry_array(pairs: list[Pair]) -> Column:
    """Pairs as ``array<struct<layer, ord, key, value>>`` (null values kept)."""
    return F.array(*[_pair_entry(p) for p in pairs])


def _pair_entry(p: Pair) -> Column:
    """The struct has its types by construction; a cast that differs in nullability alone copies it."""
    o = p.ord if isinstance(p.ord, Column) else F.lit(p.ord)
    return F.struct(F.lit(p.layer).alias("layer"), o.cast("int").alias("ord"),
                    p.key.cast("string").alias("key"), p.value.cast("string").alias("value"))


def pair_rows(df: DataFrame, pairs: list[Pair], keep: Sequence[str] = ("task_id",)) -> DataFrame:
    """``keep`` columns plus layer, ord, key, value: one row per pair that has a value; no shuffle.

    Every pair is a column of its own before the generator reads them: one array expression that renders
    them all becomes a single method, too long for the JVM to compile."""
    entries = [f"__pair_{i}" for i in range(len(pairs))]
    wide = df.select(*[col_of(df, k) for k in keep], *[_pair_entry(p).alias(e) for p, e in zip(pairs, entries, strict=True)])
    return wide.select(*[col_of(wide, k) for k in keep], F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def by_task(df: DataFrame, keys: Sequence[str] = ("task_id",)) -> DataFrame:
    """Rows dealt out by task before each becomes some thirty settings, so that the settings themselves are not
    shuffled again to be resolved and gathered per task. The number is given, as Spark would merge partitions by
    the size of the rows here, not of what they become."""
    n = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *[col_of(df, k) for k in keys])


def conf_entries(df: DataFrame, component: str, env: Mapping[str, str | Column] | None = None,
                 defaults: Mapping[str, object] | None = None) -> Column:
    return entry_array(conf_pairs(df, component, env, defaults))


def name_entries(dag_id: Column, task_name: Column) -> Column:
    return entry_array(name_pairs(dag_id, task_name))


def render_conf(df: DataFrame, component: str, env: Mapping[str, str | Column] | None = None,
                keep: Sequence[str] = ("task_id",), defaults: Mapping[str, object] | None = None) -> DataFrame:
    """One row per rendered key: ``keep`` columns, layer, ord, key,
    value. A generator over each row and a filter; no shuffle."""
    return pair_rows(df, conf_pairs(df, component, env, defaults), keep)


def resolve_layers(long_df: DataFrame, keys: Sequence[str] = ("task_id",)) -> DataFrame:
    """B18 for any long table ``(keys..., layer, ord, key, value)``: per key
    the highest layer wins and a null winner deletes the key; within a layer
    the last ``ord`` counts and the others do not; the position is that of the
    lowest layer that sets the key, as a mapping that is updated layer by
    layer keeps it. ``layer`` and ``ord`` together name an entry of a key.

    Places are one number (layer, then ord), so a key's winner and position are window aggregates of fixed
    width beside its rows. Rows are shuffled once, by task and key, or not at all if they already lie by task;
    they are read once, and what does not fit memory spills.
    """
    low = (1 << 32) - 1  # the bits of ord, counted from the least int
    place = F.shiftleft(F.col("layer").cast("long"), 32) + F.col("ord") + F.lit(1 << 31)
    place = F.coalesce(place, F.lit(-1 << 63))  # a row without a place comes last
    rows = long_df.select(*keys, "key", place.alias("__place"), "value")
    own = Window.partitionBy(*keys, "key")
    met = rows.withColumns({"__last": F.max("__place").over(own), "__at": F.min(F.col("__place").bitwiseXOR(F.lit(low))).over(own)})
    met = met.where((F.col("__place") == F.col("__last")) & F.col("value").isNotNull())
    ord_ = (F.col("__at").bitwiseXOR(F.lit(low))).bitwiseAND(F.lit(low)) - F.lit(1 << 31)
    return met.select(*keys, F.shiftright("__at", 32).cast("int").alias("layer"), ord_.cast("int").alias("ord"), "key", "value")


def extra_by_task(overrides: DataFrame, keys: Sequence[str] = ("task_id",)) -> DataFrame:
    """Per task, its extra settings as an array of (n, key, value), one per key
    (the last ``n`` of a repeated key), in ``n`` order; a null value deletes.
    Rows without a key name nothing and are skipped. First a key's entries are
    reduced, then a task's keys are gathered: its own configuration."""
    last = (overrides.where(F.col("key").isNotNull()).groupBy(*keys, "key")
            .agg(F.max(F.struct(F.col("n").cast("int").alias("n"), F.col("value").cast("string").alias("value"))).alias("w")))
    return last.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("w.n", "key", "w.value"))).alias("extra"))


def _all_pairs(df: DataFrame, env, dag_id: Column, task_name: Column, defaults) -> list[Pair]:
    return (name_pairs(dag_id, task_name) + conf_pairs(df, "base", env, defaults) + conf_pairs(df, "driver", env, defaults)
            + conf_pairs(df, "executor", env, defaults))


def _entry(layer, ord_, key, value) -> Column:
    return F.struct(layer.alias("layer"), ord_.cast("int").alias("ord"), key.alias("key"), value.alias("value"))


def _final_entries(fleet: DataFrame, overrides: DataFrame | None, env, dag_id, task_name, keys, defaults) -> DataFrame:
    """``keys`` and ``entries``: every task's final settings in order, as an
    array of (layer, ord, key, value). Rendered keys are unique, so a mapping
    updated in place is: rendered entries take the value of an override of
    their key (null removes them), the other overrides are appended in order.
    """
    dag_id = dag_id if dag_id is not None else F.lit("adhoc_airflow")
    task_name = task_name if task_name is not None else F.col(keys[0]).cast("string")
    df = fleet
    if overrides is not None:
        df = fleet.join(extra_by_task(overrides, keys), list(keys), "left")
    rendered = F.filter(entry_array(_all_pairs(df, env, dag_id, task_name, defaults)), lambda e: e["value"].isNotNull())
    if overrides is None:
        return df.select(*keys, rendered.alias("entries"))
    df = df.select(*keys, "extra", rendered.alias("entries"))
    by_key = F.map_from_entries(F.transform("extra", lambda x: F.struct(x["key"], F.struct(x["value"].alias("value")))))
    df = df.withColumns({"by_key": F.when(F.col("extra").isNotNull(), by_key),
                         "set_here": F.when(F.col("extra").isNotNull(), F.transform("entries", lambda e: e["key"]))})
    updated = F.transform("entries", lambda e: _entry(e["layer"], e["ord"], e["key"], F.when(
        F.map_contains_key("by_key", e["key"]), F.element_at("by_key", e["key"])["value"]).otherwise(e["value"])))
    added = F.transform(F.filter("extra", lambda x: ~F.array_contains("set_here", x["key"])),
                        lambda x: _entry(F.lit(LAYERS["extra"]), x["n"], x["key"], x["value"]))
    both = F.filter(F.concat(updated, added), lambda e: e["value"].isNotNull())
    return df.select(*keys, F.when(F.col("extra").isNull(), F.col("entries")).otherwise(both).alias("entries"))


def fleet_conf(fleet: DataFrame, overrides: DataFrame | None = None,
               env: Mapping[str, str | Column] | None = None, dag_id: Column | None = None,
               task_name: Column | None = None, keys: Sequence[str] = ("task_id",),
               defaults: Mapping[str, object] | None = None) -> DataFrame:
    """B16-B19, B26 for a whole fleet: every task's final settings as rows
    ``(keys..., layer, ord, key, value)``.

    Only the extra layer can collide with rendered keys (rendered keys name
    their component), so resolution happens inside each row: overrides are
    gathered per task and joined once to the fleet, one row per task; what it
    costs depends on the task's own overrides. There is one path for every
    size, no job runs before the action, and Spark chooses the join from real
    sizes. Overrides of tasks that the fleet does not list have no effect.
    """
    # the outer form, as every task has entries: of the inner one Spark infers a filter on their number,
    # and pushes it below the join with the whole rendering written out
    return _final_entries(fleet, overrides, env, dag_id, task_name, keys, defaults).select(
        *keys, F.inline_outer("entries")).where(F.col("key").isNotNull())


def fleet_conf_text(fleet: DataFrame, overrides: DataFrame | None = None,
                    env: Mapping[str, str | Column] | None = None, dag_id: Column | None = None,
                    task_name: Column | None = None, keys: Sequence[str] = ("task_id",),
                    defaults: Mapping[str, object] | None = None) -> DataFrame:
    """B20 for a whole fleet, one text per task computed inside its row (no
    shuffle of rendered keys): ``key=value`` lines in order."""
    entries = _final_entries(fleet, overrides, env, dag_id, task_name, keys, defaults)
    lines = F.transform("entries", lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return entries.select(*keys, F.array_join(lines, "\n").alias("conf_text"))


def conf_text(conf_rows: DataFrame, keys: Sequence[str] = ("task_id",)) -> DataFrame:
    """B20 for any long table of resolved settings: ``key=value`` lines by
    layer, then place in it, one text per task (a task's keys are bounded by
    the settings it has)."""
    line = F.struct("layer", "ord", F.concat_ws("=", "key", "value").alias("line"))
    return (conf_rows.groupBy(*keys).agg(F.sort_array(F.collect_list(line)).alias("lines"))
            .select(*keys, F.array_join(F.col("lines.line"), "\n").alias("conf_text")))

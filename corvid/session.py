"""Session settings and shared scratch locations.

Jobs never pick a machine-local folder on their own: scratch output goes under
the shared folder the cluster names in ``spark.checkpoint.dir``. Only when a
session has none (a bare test session) do we create one and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes; the caller's session keeps any
# value it already has for keys not listed here.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "corvid", extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the bench; production callers bring their own."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "64",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


_OWN_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; a checkpoint folder already set on the context is
    used next. Only a session on this machine alone (as in tests) gets a
    folder of its own; on a cluster executors would not see it, so there a
    session without a shared folder is an error.
    """
    sc = spark.sparkContext
    root = (sc.getConf().get("spark.checkpoint.dir", None) or _OWN_ROOTS.get(sc.applicationId)
            or sc.getCheckpointDir())
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _OWN_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="corvid-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """Where this application's scratch output goes."""
    return f"{checkpoint_root(spark)}/corvid/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared root, one per call, so runs never collide."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch output. Results of queries read from it, so call it after their last use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"

"""The load step (A11) as an incremental job.

Files arriving under a landing folder are loaded to parquet exactly once: the
stream's checkpoint (under the shared checkpoint root) records which files
were committed, so a rerun - or a restart after a lost executor or driver -
picks up only new files. ``availableNow`` processes what is there and stops,
so the step runs on a schedule like the batch one.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corvid.session import checkpoint_root
from corvid.sources.files import read_csv
from corvid.sources.rejects import REJECTED, accepted, checked_options, rejected, with_line, with_rejects

#: Partition column of a stream's table that keeps rejected lines.
SIDE = "rejected"


def _writer(spark: SparkSession, src: str, dst: str, schema, checkpoint, max_files_per_batch, quarantine=False):
    if schema is None:
        schema = read_csv(spark, src, recursive=True).schema
    checkpoint = checkpoint or f"{checkpoint_root(spark)}/corvid-streams/{quote(dst.rstrip('/'), safe='')}"
    reader = (spark.readStream.schema(with_line(schema) if quarantine else schema).option("header", True)
              .option("ignoreLeadingWhiteSpace", True).option("recursiveFileLookup", True))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if not quarantine:
        writer = reader.csv(src).writeStream
    else:
        rows = with_rejects(checked_options(reader).csv(src), schema)
        writer = rows.withColumn(SIDE, F.col(REJECTED).isNotNull()).writeStream.partitionBy(SIDE)
    return writer.format("parquet").option("path", dst).option("checkpointLocation", checkpoint)


def stream_load(spark: SparkSession, src: str, dst: str, schema: StructType | str | None = None,
                checkpoint: str | None = None, max_files_per_batch: int | None = None, quarantine: bool = False) -> str:
    """Load new CSV files under ``src`` into parquet at ``dst``; returns ``dst``.

    Without ``schema`` the types are inferred once from what is already there
    (as the batch step does); give one for a steady stream. With ``quarantine`` lines that do not fit are
    kept in a partition of their own, committed exactly once like the others; :func:`loaded` reads both.
    """
    query = _writer(spark, src, dst, schema, checkpoint, max_files_per_batch, quarantine).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return dst


def loaded(spark: SparkSession, dst: str) -> tuple[DataFrame, DataFrame]:
    """The rows that a stream with ``quarantine`` loaded, and file, line and reason of those it rejected."""
    rows = spark.read.parquet(dst)
    side = F.col(SIDE).cast("string")
    return accepted(rows.where(side == "false").drop(SIDE)), rejected(rows.where(side == "true"))


def start_stream_load(spark: SparkSession, src: str, dst: str, schema: StructType | str,
                      every: str = "1 minute", checkpoint: str | None = None,
                      max_files_per_batch: int | None = None, quarantine: bool = False) -> StreamingQuery:
    """The same load kept running: a micro-batch ``every`` interval, with the
    same exactly-once checkpoint. Returns the running query."""
    return (_writer(spark, src, dst, schema, checkpoint, max_files_per_batch, quarantine)
            .trigger(processingTime=every).start())

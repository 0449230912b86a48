"""File sources and sinks: CSV scan (A03) and its rejected lines (A11), parquet
scan (A04), parquet replace (A05) and raw landing of text files by lines (A10;
byte by byte in :mod:`corvid.sources.landing`)."""

from __future__ import annotations

import re
import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from corvid.functions.text import named_path
from corvid.sources.replace import beside, removed_on_failure, restored, switch


# the one function here that runs in tasks goes to executors by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_csv(spark: SparkSession, uri: str | list[str], schema: StructType | str | None = None, *,
             header: bool = True, recursive: bool = False) -> DataFrame:
    """CSV with a header row; blanks leading each field are ignored.

    With ``schema`` the scan is a single pass. Without one, types are inferred
    from all rows, which costs an extra pass, and whole numbers are narrowed to
    ``int`` where they fit; give a schema on large inputs.
    ``recursive`` reads a landed tree (see :func:`land_raw`) without turning
    its folders into columns.
    """
    reader = (spark.read.option("header", header)
              .option("ignoreLeadingWhiteSpace", True))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(uri)


def read_parquet(spark: SparkSession, uri: str | list[str]) -> DataFrame:
    """Parquet scan; projections and filters applied later reach the scan."""
    if isinstance(uri, str):
        return spark.read.parquet(uri)
    return spark.read.parquet(*uri)


def write_parquet(df: DataFrame, uri: str, partition_by: list[str] | None = None) -> str:
    """Replace whatever is stored at ``uri`` with ``df``; return ``uri``.

    The table is written beside ``uri`` and takes its place when it is complete: a failing write leaves
    the old table as it was, and ``df`` may be computed from what it replaces.
    """
    spark, new = df.sparkSession, beside(uri)
    restored(spark, uri)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with removed_on_failure(spark, new):
        writer.parquet(new)
        switch(spark, new, uri)
    return uri


_GLOB = re.compile(r"[*?\[{]")


def plain_path(path: str) -> str:
    """A path without scheme and authority."""
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?", "", path)


def _base(src: str) -> str:
    """The folder of ``src`` above its first pattern, as paths are written (no scheme)."""
    plain = plain_path(src)
    return plain[:(_GLOB.search(plain) or re.search(r"\Z", plain)).start()].rpartition("/")[0] + "/"


def base_folder(srcs: list[str]) -> str:
    """The folder above the first pattern that all sources share (``/`` if they share none)."""
    base = min((_base(s) for s in srcs), key=len)
    return base if all(_base(s).startswith(base) for s in srcs) else "/"


def _repeat_headers(batches):
    """Lines sorted by file and place; a file whose lines do not begin with its first split gets its header.

    What a task holds of one file becomes one part, which so begins with the header once.
    """
    last = None
    for b in batches:
        source, chunk = b.column("source"), b.column("chunk")
        lines, runs = b.column("value").to_pylist(), pc.run_end_encode(source)
        start = 0
        for end in runs.run_ends.to_pylist():
            name, head = source[start].as_py(), b.column("header")[start].as_py()
            if name != last and chunk[start].as_py() > 0 and head is not None:
                lines[start] = f"{head}\n{lines[start]}"
            last, start = name, end
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), source, chunk, b.column("pos")],
                                         names=["value", "source", "chunk", "pos"])


def land_raw(spark: SparkSession, src: str | list[str], dst: str, *, header: bool = True) -> str:
    """Copy a set of text files under ``dst``, line by line, replacing what was there.
    :func:`corvid.sources.landing.land_files` copies files as they are, without a shuffle.

    Each source file lands under ``dst/source=<its path below the pattern's
    folder>/``, one part per task that read a piece of it, so no file is ever
    held whole by one task and files of one name in different folders stay
    apart. With ``header`` the first line of a file is repeated at the top of
    every later split, so every landed part is a complete CSV and reading the
    tree back with a header keeps all rows. Lines keep their order within a
    part. An empty file has no lines and leaves nothing (Spark's readers do
    not see it).

    Headers are fetched only for files that can span splits, from their first
    split; whether their table is broadcast is left to Spark.
    """
    srcs = [src] if isinstance(src, str) else list(src)
    base = base_folder(srcs)

    def below(path):
        return F.when(F.instr(path, base) > 0, F.substring(path, F.instr(path, base) + len(base), F.length(path))).otherwise(path)

    rows = (spark.read.text(srcs)
            .select("value", below(named_path("_metadata.file_path")).alias("source"), F.col("_metadata.file_block_start").alias("chunk"),
                    F.col("_metadata.file_size").alias("size")))
    least_split = min(_size(spark, "spark.sql.files.openCostInBytes"), _size(spark, "spark.sql.files.maxPartitionBytes"))
    lines = rows.withColumn("pos", F.monotonically_increasing_id())  # the order within a task
    if header:
        heads = (rows.where((F.col("chunk") == 0) & (F.col("size") > least_split))
                 .groupBy("source").agg(F.first("value").alias("header")))
        lines = (lines.join(heads, "source", "left").select("value", "source", "chunk", "pos", "header")
                 .sortWithinPartitions("source", "chunk", "pos")
                 .mapInArrow(_repeat_headers, "value string, source string, chunk long, pos long"))
    (lines.sortWithinPartitions("source", "chunk", "pos").select("value", "source")
     .write.mode("overwrite").partitionBy("source").text(dst))
    return dst


def _size(spark: SparkSession, name: str) -> int:
    """A size setting in bytes."""
    value = str(spark.conf.get(name)).lower().strip()
    number, unit = re.fullmatch(r"([0-9]+) *([kmgt]?)i?b?", value).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]

"""Byte-exact landing of files (A10): every file arrives as it is, empty ones too.

Spark lists the files and cuts them into byte ranges; the ranges, not the bytes, are dealt to tasks, and
each task copies its ranges through a few megabytes of memory straight from store to store. Where the
target takes writes at any place (a mounted folder that all executors share) the ranges of a large file
are copied side by side into one file; other stores take a file from its start to its end, so there a file
is one range. Everything is written beside the target and then takes its place, with a manifest (one row
per range: source, part, start, length, sha256) that readers of the folder do not see.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corvid.functions.text import named_path
from corvid.sources.files import base_folder, plain_path
from corvid.sources.replace import beside, removed_on_failure, switch

# the functions that run in tasks go to executors by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MANIFEST = "_manifest"
RANGE_BYTES, BUFFER = 64 << 20, 4 << 20
_RANGE = "source string, part int, start long, length long"
#: How Hadoop and Arrow name the same stores (fixed values).
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    m = re.match(r"([a-zA-Z][a-zA-Z0-9+.\-]*):(?://([^/]*))?(/.*)", path, re.S)
    if m is None or m[1] == "file":
        return pafs.LocalFileSystem(), m[3] if m else path
    store, root = pafs.FileSystem.from_uri(f"{_SCHEMES.get(m[1], m[1])}://{m[2] or ''}/")
    return store, root.rstrip("/") + m[3]


def takes_ranges(path: str) -> bool:
    """Whether files below ``path`` can be written at any place."""
    return isinstance(_store(path)[0], pafs.LocalFileSystem)


def _blocks(path: str, start: int, length: int):
    """The bytes of a range, a few megabytes at a time."""
    store, name = _store(path)
    with store.open_input_file(name) as f:
        at, end = start, start + length
        while at < end:
            block = f.read_at(min(BUFFER, end - at), at)
            if not block:
                raise OSError(f"{path} ended at {at}; it had {end} bytes or more when it was listed")
            yield at, block
            at += len(block)


def _copy(path: str, start: int, length: int, target: str) -> str:
    """Copy a range to the same place of the target; returns the sha256 of its bytes. Repeats do no harm."""
    store, name = _store(target)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    digest = hashlib.sha256()
    if isinstance(store, pafs.LocalFileSystem):
        out = os.open(name, os.O_WRONLY | os.O_CREAT, 0o644)
        try:
            for at, block in _blocks(path, start, length):
                digest.update(block)
                view = memoryview(block)
                while view:
                    done = os.pwrite(out, view, at)
                    at, view = at + done, view[done:]
        finally:
            os.close(out)
    else:
        with store.open_output_stream(name) as out:
            for _, block in _blocks(path, start, length):
                digest.update(block)
                out.write(block)
    return digest.hexdigest()


def _state(path: str, start: int, length: int) -> str:
    """sha256 of a range and the size of its file; empty if the range cannot be read."""
    digest = hashlib.sha256()
    try:
        for _, block in _blocks(path, start, length):
            digest.update(block)
        store, name = _store(path)
        return f"{digest.hexdigest()} {store.get_file_info(name).size}"
    except OSError:
        return ""


def _per_range(act):
    """Arrow batches of ranges to the same with what ``act(row)`` returns."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in ("source", "part", "start", "length")), pa.array([act(r) for r in b.to_pylist()], pa.string())],
                names=["source", "part", "start", "length", "sha256"])
    return run


def listed(spark: SparkSession, src: str | list[str]) -> DataFrame:
    """(path, source, length) of files, by Spark's listing; ``source`` is the path below the folder above the first pattern."""
    srcs = [src] if isinstance(src, str) else list(src)
    base = base_folder(srcs)
    files = spark.read.format("binaryFile").load(srcs)

    def plain(path: Column | str) -> Column:
        return F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?", "")

    # scans leave empty files out, so what is listed without a length is empty; names only, as Spark's listing holds them
    names = spark.createDataFrame([(f,) for f in files.inputFiles()], "encoded string").select(named_path("encoded").alias("path"))
    names = names.withColumn("plain", plain("path"))
    sized = files.select(plain(named_path("_metadata.file_path")).alias("plain"), "length")
    below = F.when(F.startswith("plain", F.lit(base)), F.substring("plain", F.lit(len(base) + 1), F.length("plain"))).otherwise(
        F.regexp_replace("plain", "^/+", ""))
    return names.join(sized, "plain", "left").select("path", below.alias("source"), F.coalesce("length", F.lit(0)).alias("length"))


def _ranges(files: DataFrame, size: int | None) -> DataFrame:
    """The byte ranges of files (whole files without a size): an empty file is one empty range."""
    files = files.withColumnRenamed("length", "whole")
    step = F.lit(size) if size else F.greatest("whole", F.lit(1))
    last = F.greatest(F.ceil(F.col("whole") / step) - 1, F.lit(0)).cast("int")
    each = files.select("path", "source", "whole", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    start = F.col("part") * step.cast("long")
    return each.select("path", "source", "part", start.alias("start"), F.least(step.cast("long"), F.col("whole") - start).alias("length"))


def land_files(spark: SparkSession, src: str | list[str], dst: str, *, range_bytes: int = RANGE_BYTES) -> str:
    """Copy files under ``dst``, byte by byte, replacing what was there; returns ``dst``.

    A file lands under its path below the folder above the first pattern of ``src``, so files of one name
    in different folders stay apart. Nothing is shuffled but the rows that name the ranges. A file that
    shrinks meanwhile fails the job, and a failing job leaves the earlier landing as it was.
    """
    new = beside(dst)
    ranges = _ranges(listed(spark, src), range_bytes if takes_ranges(new) else None)
    with removed_on_failure(spark, new):
        tasks = max(1, ranges.count())  # a range each; they are too small for Spark to deal them by size
        copied = ranges.repartition(tasks, "path", "part").mapInArrow(
            _per_range(lambda r: _copy(r["path"], r["start"], r["length"], f"{new}/{r['source']}")), f"{_RANGE}, sha256 string")
        copied.write.parquet(f"{new}/{MANIFEST}")
        switch(spark, new, dst)
    return dst


def manifest(spark: SparkSession, dst: str) -> DataFrame:
    """What landed: source, part, start, length, sha256; the parts of a source in order of ``part`` are the file."""
    return spark.read.parquet(f"{dst.rstrip('/')}/{MANIFEST}")


def verify_landing(spark: SparkSession, dst: str) -> DataFrame:
    """One row per landed file: source, n_bytes, n_parts, identical (every range has its digest still, and there is no byte more)."""
    root, known = dst.rstrip("/"), manifest(spark, dst)
    now = known.drop("sha256").repartition(max(1, known.count()), "source", "part").mapInArrow(
        _per_range(lambda r: _state(f"{root}/{r['source']}", r["start"], r["length"])), f"{_RANGE}, sha256 string")
    state = now.select("source", "part", F.col("sha256").alias("state"))
    met = known.join(state, ["source", "part"], "left").groupBy("source").agg(
        F.sum("length").alias("n_bytes"), F.count(F.lit(1)).alias("n_parts"),
        F.bool_and(F.coalesce(F.split_part("state", F.lit(" "), F.lit(1)) == F.col("sha256"), F.lit(False))).alias("same"),
        F.max(F.split_part("state", F.lit(" "), F.lit(2))).alias("size"))
    return met.select("source", "n_bytes", "n_parts", (F.col("same") & (F.col("size") == F.col("n_bytes").cast("string"))).alias("identical"))

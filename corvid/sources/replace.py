"""Replacing a stored folder (A05): write beside it, then switch.

The new folder is complete before the old one is touched, so a failing write leaves the old table
readable, and a table may be replaced by something that is computed from it. The switch is two renames.
Should the driver end between them, the old folder still lies beside its place under a name of its own
and the next write puts it back first. Names that begin with a dot are not seen by readers of the folder
above. Renames are one step each on HDFS and mounted folders; on object stores they copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _split(dst: str) -> tuple[str, str]:
    head, _, name = dst.rstrip("/").rpartition("/")
    return f"{head}/", name


def beside(dst: str) -> str:
    """A fresh folder next to ``dst``."""
    head, name = _split(dst)
    return f"{head}.{name}.new-{uuid.uuid4().hex[:12]}"


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_note(spark: SparkSession, path: str) -> str | None:
    """A small text file, None if there is none."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file; it is complete before it has its name."""
    fs, new = _at(spark, beside(path))
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(_at(spark, path)[1], False)
    if not fs.rename(new, _at(spark, path)[1]):
        raise OSError(f"could not write {path}")


def restored(spark: SparkSession, dst: str) -> bool:
    """Put back a folder that an interrupted switch moved away; whether there was one."""
    head, name = _split(dst)
    fs, p = _at(spark, f"{head}{name}")
    _, folder = _at(spark, head or ".")
    if fs.exists(p) or not fs.exists(folder):
        return False
    old = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith(f".{name}.old-")),
                 key=lambda q: fs.getFileStatus(q).getModificationTime())
    return bool(old) and fs.rename(old[-1], p)


def switch(spark: SparkSession, new: str, dst: str) -> None:
    """Put the finished folder ``new`` in the place of ``dst``."""
    head, name = _split(dst)
    fs, place = _at(spark, f"{head}{name}")
    _, fresh = _at(spark, new)
    _, old = _at(spark, f"{head}.{name}.old-{uuid.uuid4().hex[:12]}")
    fs.mkdirs(place.getParent())
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"could not move {dst} away")
    if not fs.rename(fresh, place):
        if had:
            fs.rename(old, place)
        raise OSError(f"could not move {new} to {dst}")
    if had:
        fs.delete(old, True)
    spark.catalog.refreshByPath(f"{head}{name}")  # listings that Spark keeps name files that are gone


@contextmanager
def removed_on_failure(spark: SparkSession, new: str) -> Iterator[None]:
    try:
        yield
    except BaseException:
        remove(spark, new)
        raise

"""ELT steps and how they chain.

A step is a plain Python function of a session and its inputs whose body is a
DataFrame plan; a stored step returns the location of what it wrote, which is
the next step's input. Writing between steps also cuts the lineage, so a lost
executor never replays an earlier step.
"""

from __future__ import annotations

import functools
import hashlib
import inspect
import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from corvid.operators.aggregate import group_avg, sort_by
from corvid.sources.files import read_csv, read_parquet, write_parquet
from corvid.sources.rejects import REJECTED, read_csv_checked, write_split
from corvid.sources.replace import read_note, write_note


def path_stem(uri: str, suffix: str = ".csv") -> str:
    """A13 for one location: what :func:`corvid.functions.text.file_stem` gives for its path, a trailing ``/`` ignored."""
    head, _, name = uri.rpartition("/")
    if not name:
        name = head.rpartition("/")[2]
    name = name.lower()
    return name[:len(name) - len(suffix)] if suffix and name.endswith(suffix) else name


def load_step(spark: SparkSession, uri: str, root: str, schema: StructType | str | None = None, *,
              quarantine: bool = False, header: bool = True) -> str:
    """CSV at ``uri`` -> parquet at ``<root>/load/<stem>/``; returns it.
    Types are inferred unless a ``schema`` is given (give one on large inputs).

    Values that do not parse are null, as Spark's reader has them. With ``quarantine`` the lines that hold
    them, and those with another number of fields, go to :func:`rejected_of` instead, with file, line and
    reason, in the same pass and write; the loaded table then has the reserved column ``_rejected``, null.
    """
    dst = f"{root.rstrip('/')}/load/{path_stem(uri)}/"
    if not quarantine:
        return write_parquet(read_csv(spark, uri, schema, header=header, recursive=True), dst)
    df = read_csv_checked(spark, uri, schema, header=header, recursive=True)
    return write_split(df, F.col(REJECTED).isNotNull(), dst, rejected_of(uri, root))[0]


def rejected_of(uri: str, root: str) -> str:
    """Where the load step puts the lines of ``uri`` that it rejects."""
    return f"{root.rstrip('/')}/rejected/{path_stem(uri)}/"


def transform_step(spark: SparkSession, uri: str, root: str,
                   key: str = "Year", value: str = "Score") -> str:
    """Parquet -> mean of ``value`` per ``key``, ordered by ``key`` ->
    parquet at ``<root>/transform/<stem>/``; returns it."""
    agg = sort_by(group_avg(read_parquet(spark, uri), [key], [value]), [key])
    return write_parquet(agg, f"{root.rstrip('/')}/transform/{path_stem(uri, '')}/")


StepFn = Callable[[SparkSession, str, str], str]


def run_pipeline(spark: SparkSession, steps: Sequence[StepFn], uri: str, root: str, *, resume: bool = False) -> DataFrame:
    """Each step's output location feeds the next; returns the last output.

    With ``resume`` every step that ends leaves a record under ``<root>/_steps``, bound to the step (its
    name, code and arguments), to its input's location and to the files there and in its output. A later
    run skips the steps whose records still hold: a chain that broke goes on where it broke, and a
    changed input, step or output runs again, with all that follows from it.
    """
    for number, s in enumerate(steps):
        if not resume:
            uri = s(spark, uri, root)
            continue
        note = f"{root.rstrip('/')}/_steps/{number}.json"
        bound = {"step": identity(s), "input": uri, "files": file_state(spark, uri)}
        known = json.loads(read_note(spark, note) or "{}")
        if known.get("bound") == bound and known.get("made") == file_state(spark, known["output"]):
            uri = known["output"]
            continue
        out = s(spark, uri, root)
        write_note(spark, note, json.dumps({"bound": bound, "output": out, "made": file_state(spark, out)}))
        uri = out
    return read_parquet(spark, uri)


def identity(fn: Callable[..., Any]) -> list:
    """What a step is: name, a digest of its code, and the arguments it is bound to."""
    if isinstance(fn, functools.partial):
        return [identity(fn.func), repr(fn.args), repr(sorted(fn.keywords.items()))]
    fn = inspect.unwrap(fn)
    code = getattr(fn, "__code__", None)
    held = [c.cell_contents for c in getattr(fn, "__closure__", None) or ()]
    plain = [v for v in held if v is None or isinstance(v, (str, int, float, bool, tuple))]
    text = repr((code and (code.co_code, [c for c in code.co_consts if not inspect.iscode(c)], code.co_names),
                 getattr(fn, "__defaults__", None), getattr(fn, "__kwdefaults__", None), plain))
    return [getattr(fn, "__module__", ""), getattr(fn, "__qualname__", repr(fn)), hashlib.sha256(text.encode()).hexdigest()]


def file_state(spark: SparkSession, uri: str) -> list | None:
    """Number, bytes and a digest of names, sizes and times of the files at ``uri``, by Spark's listing; None without any."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(uri)
    except AnalysisException:
        return None
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(each).cast("string")).first()
    return [row[0], row[1], row[2]] if row[0] else None


def sql_step(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None,
             **tables: DataFrame) -> DataFrame:
    """SQL with named parameter markers (``:name``) bound to values.

    Values are bound, never pasted into the text. Tables are passed as
    DataFrames and referenced as ``{name}`` in the text.
    """
    return spark.sql(text, args=dict(args or {}), **tables)


def with_scalar(df: DataFrame, scalar: DataFrame, name: str) -> DataFrame:
    """A value computed by one plan (a one-row, one-column DataFrame)
    sizes the next, as a scalar subquery evaluated once per job."""
    return df.withColumn(name, scalar.scalar())


def step(fn: Callable[..., Any]) -> Callable[..., Any]:
    """Make a user function a step. Inputs are bound by keyword; if the
    function has a ``spark`` parameter (in any position) the active session is
    passed to it unless one is given."""
    wants_spark = "spark" in inspect.signature(fn).parameters

    @functools.wraps(fn)
    def run(*args: Any, spark: SparkSession | None = None, **kwargs: Any) -> Any:
        if wants_spark:
            kwargs["spark"] = spark or SparkSession.getActiveSession()
        return fn(*args, **kwargs)

    return run

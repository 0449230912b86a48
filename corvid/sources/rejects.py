"""Lines that do not fit their schema, set aside with file and reason (A11), and one write for both sides of a split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corvid.functions.text import named_path
from corvid.sources.files import read_csv
from corvid.sources.replace import beside, exists, remove, removed_on_failure, restored, switch

#: Reserved column: null in rows that fit; else the file, the line as it was and what does not fit.
REJECTED = "_rejected"
_LINE = "_rejected_line"
_SIDE = "_rejected_side"


def as_struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def with_line(schema: StructType | str) -> StructType:
    """The schema with the column in which the CSV reader keeps lines that do not fit."""
    return StructType([*as_struct(schema).fields, StructField(_LINE, StringType())])


def checked_options(reader):
    """What a reader (batch or stream) of a schema :func:`with_line` needs."""
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)


def with_rejects(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Columns of ``schema`` and ``_rejected``, from rows read by a schema :func:`with_line`.

    The reader itself says which lines do not fit. The reason is looked up for those lines alone: another
    number of fields (``fields``), or the columns whose text is no value of their type.
    """
    fields = as_struct(schema).fields
    texts = ", ".join(f"`{n}` string" for n in [*(f.name for f in fields), _LINE])
    line = F.col(_LINE)
    split = F.from_csv(line, texts, {"ignoreLeadingWhiteSpace": "true", "columnNameOfCorruptRecord": _LINE})
    wrong = [F.when(split[f.name].isNotNull() & F.col(f"`{f.name}`").isNull(), f"{f.name} is no {f.dataType.simpleString()}") for f in fields]
    reason = F.when(split[_LINE].isNotNull(), "fields").otherwise(F.concat_ws(", ", *wrong))
    rejected = F.when(line.isNotNull(), F.struct(named_path("_metadata.file_path").alias("file"), line.alias("line"), reason.alias("reason")))
    return df.select(*[F.col(f"`{f.name}`") for f in fields], rejected.alias(REJECTED))


def read_csv_checked(spark: SparkSession, uri: str | list[str], schema: StructType | str | None = None, *,
                     header: bool = True, recursive: bool = False) -> DataFrame:
    """:func:`read_csv` that keeps what it cannot read: columns of ``schema`` and ``_rejected``, in one pass.

    Without ``schema`` types are inferred, so that every value fits, and only lines with another number
    of fields are rejected. An empty field is null, not a reason.
    """
    if schema is None:
        schema = read_csv(spark, uri, header=header, recursive=recursive).schema
    reader = checked_options(spark.read).option("header", header).option("ignoreLeadingWhiteSpace", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return with_rejects(reader.schema(with_line(schema)).csv(uri), schema)


def accepted(df: DataFrame) -> DataFrame:
    """The rows that fit, without the reserved column."""
    return df.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected(df: DataFrame) -> DataFrame:
    """file, line and reason of the lines that do not fit."""
    return df.where(F.col(REJECTED).isNotNull()).select(f"{REJECTED}.*")


def write_split(df: DataFrame, bad: Column, good_dst: str, bad_dst: str) -> tuple[str, str]:
    """Replace ``good_dst`` by the rows that are not ``bad`` and ``bad_dst`` by the others, computing ``df`` once.

    One write, partitioned by the verdict; then each side takes its place. Both hold the columns of ``df``.
    """
    spark, new = df.sparkSession, beside(good_dst)
    with removed_on_failure(spark, new):
        df.withColumn(_SIDE, F.coalesce(bad, F.lit(False))).write.partitionBy(_SIDE).parquet(new)
        for side, dst in (("false", good_dst), ("true", bad_dst)):
            part = f"{new}/{_SIDE}={side}"
            if not exists(spark, part):  # no such rows: a table all the same
                spark.createDataFrame([], df.schema).write.parquet(part)
            restored(spark, dst)
            switch(spark, part, dst)
        remove(spark, new)
    return good_dst, bad_dst

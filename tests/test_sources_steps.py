"""Sources, sinks and steps."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession, functions as F, types as T

from corvid.plans.steps import (load_step, path_stem, run_pipeline, sql_step, step, transform_step,
                                with_scalar)
from corvid.session import scratch_dir
from corvid.sources.files import land_raw, read_csv, read_parquet, write_parquet
from corvid.sources.literal import rows
from corvid.streaming.incremental import stream_load


def _write(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_literal_rows(spark):
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in
                           ("firstname", "middlename", "lastname", "id", "gender")] +
                          [T.StructField("salary", T.IntegerType(), True)])
    df = rows(spark, [("Ann", "", "Lee", "1", "F", 10), ("Bo", "K", "", "", "M", -1)], schema)
    assert df.schema == schema and df.count() == 2
    assert rows(spark, [("Alice", 1)]).columns == ["_1", "_2"]
    inferred = rows(spark, [{"name": "Alice", "age": 1}])
    assert inferred.columns == ["age", "name"] and dict(inferred.dtypes)["age"] == "bigint"


def test_csv_blanks_quotes_and_inference(spark):
    root = scratch_dir(spark, "t-csv")
    _write(f"{root}/m.csv", 'Year, "Score", "Title"\n1968,  86, "Greetings"\n1970, 17, "Bloody Mama, The"\n')
    df = read_csv(spark, f"{root}/m.csv")
    assert df.columns == ["Year", "Score", "Title"]
    assert dict(df.dtypes) == {"Year": "int", "Score": "int", "Title": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [(1968, 86, "Greetings"), (1970, 17, "Bloody Mama, The")]
    typed = read_csv(spark, f"{root}/m.csv", "Year long, Score double, Title string")
    assert dict(typed.dtypes)["Year"] == "bigint"


def test_parquet_replace(spark):
    dst = f"{scratch_dir(spark, 't-pq')}/out"
    write_parquet(spark.range(10), dst)
    assert write_parquet(spark.range(3), dst) == dst
    assert read_parquet(spark, dst).count() == 3


def test_land_raw_keeps_every_row_across_splits(spark):
    root = scratch_dir(spark, "t-land")
    lines = ["k,v"] + [f"{i},{'x' * 40}" for i in range(20000)]
    _write(f"{root}/src/big.csv", "\n".join(lines) + "\n")
    _write(f"{root}/src/small.csv", "k,v\n1,a\n2,b\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024))
    try:
        dst = land_raw(spark, f"{root}/src/*.csv", f"{root}/extract")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    parts = [p for p in os.listdir(f"{dst}/source=big.csv") if p.startswith("part-")]
    assert len(parts) > 1  # the big file landed as several parts
    back = read_csv(spark, f"{dst}/source=big.csv", "k long, v string", recursive=True)
    assert back.count() == 20000 and back.agg(F.countDistinct("k")).first()[0] == 20000
    assert read_csv(spark, f"{dst}/source=small.csv", recursive=True).count() == 2


def test_path_stems():
    assert path_stem("s3a://b/extract/Films.csv") == "films"
    assert path_stem("s3a://b/load/films/") == "films"
    assert path_stem("/x/extract/source=Movies.csv") == "source=movies"


def test_load_transform_chain_and_pipeline(spark):
    root = scratch_dir(spark, "t-elt")
    _write(f"{root}/src/films.csv", "Year, Score, Title\n2000, 50, a\n2000, 70, b\n1999, 10, c\n2001,, d\n")
    loaded = load_step(spark, f"{root}/src/films.csv", root)
    assert loaded.endswith("/load/films/")
    out = transform_step(spark, loaded, root)
    assert out.endswith("/transform/films/")
    got = [tuple(r) for r in read_parquet(spark, out).collect()]
    assert sorted(got) == [(1999, 10.0), (2000, 60.0), (2001, None)]
    assert read_parquet(spark, out).columns == ["Year", "avg(Score)"]
    chained = run_pipeline(spark, [load_step, transform_step], f"{root}/src/films.csv", root)
    assert sorted(tuple(r) for r in chained.collect()) == sorted(got)


def test_sql_parameters_and_scalar(spark):
    df = spark.range(10)
    got = sql_step(spark, "select count(*) as n from {t} where id >= :lo and id < :hi", {"lo": 3, "hi": 7}, t=df)
    assert got.first().n == 4
    # a value bound as a parameter is never parsed as SQL
    txt = sql_step(spark, "select :v as v", {"v": "1; drop table x"}).first().v
    assert txt == "1; drop table x"
    sized = with_scalar(df, spark.range(5).select((F.count("*") % 3 + 1).alias("n")), "executors")
    assert {r.executors for r in sized.collect()} == {3}


def test_step_injects_session(spark):
    @step
    def needs(x, spark: SparkSession):
        return spark.range(x).count()

    @step
    def first_param(spark, x):
        return spark.range(x).count()

    @step
    def plain(x):
        return x + 1

    assert needs(x=3) == 3 and first_param(x=2) == 2 and plain(x=1) == 2
    assert needs(x=4, spark=spark) == 4


def test_stream_load_is_incremental(spark):
    root = scratch_dir(spark, "t-stream")
    _write(f"{root}/in/a.csv", "Year, Score\n2000, 1\n2001, 2\n")
    schema = "Year int, Score int"
    dst = stream_load(spark, f"{root}/in", f"{root}/out", schema, checkpoint=f"{root}/ckpt")
    assert read_parquet(spark, dst).count() == 2
    _write(f"{root}/in/b.csv", "Year, Score\n2002, 3\n")
    stream_load(spark, f"{root}/in", f"{root}/out", schema, checkpoint=f"{root}/ckpt")
    assert sorted(r.Year for r in read_parquet(spark, dst).collect()) == [2000, 2001, 2002]


def test_shared_scratch_is_under_checkpoint_root(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(root.rstrip("/"))
    with pytest.raises(Exception):
        read_csv(spark, f"{scratch_dir(spark, 'missing')}/nothing.csv").collect()


def test_land_raw_awkward_files(spark):
    root = scratch_dir(spark, "t-land-odd")
    _write(f"{root}/src/crlf.csv", "k,v\r\n1,a\r\n2,b\r\n")
    _write(f"{root}/src/no_newline.csv", "k,v\n1,a\n2,b")
    _write(f"{root}/src/header_only.csv", "k,v\n")
    _write(f"{root}/src/empty.csv", "")
    dst = land_raw(spark, f"{root}/src/*.csv", f"{root}/extract")
    def back(name):
        return sorted(tuple(r) for r in read_csv(spark, f"{dst}/source={name}", "k int, v string",
                                                 recursive=True).collect())
    assert back("crlf.csv") == [(1, "a"), (2, "b")]
    assert back("no_newline.csv") == [(1, "a"), (2, "b")]
    assert back("header_only.csv") == []
    assert not os.path.exists(f"{dst}/source=empty.csv")  # no lines, nothing to land


def test_land_raw_keeps_files_of_one_name_apart(spark):
    root = scratch_dir(spark, "t-land-same")
    for folder in ("one", "two x+y%"):
        _write(f"{root}/src/{folder}/a.csv", "k,v\n" + "".join(f"{folder[0]}{i},{'x' * 40}\n" for i in range(20000)))
    for i in range(40):
        _write(f"{root}/many/d{i}/a.csv", f"k,v\n{i}a,1\n{i}b,2\n{i}c,3\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024))
    try:
        dst = land_raw(spark, f"{root}/src/*/*.csv", f"{root}/extract")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    back = read_csv(spark, dst, "k string, v string", recursive=True)
    assert back.count() == 40000 and back.select("k").distinct().count() == 40000
    small = read_csv(spark, land_raw(spark, f"{root}/many/*/a.csv", f"{root}/small"), recursive=True)
    assert small.count() == 120 and small.where("k = 'k'").count() == 0


def test_land_raw_without_header_copies_lines(spark):
    root = scratch_dir(spark, "t-land-plain")
    _write(f"{root}/src/log.txt", "".join(f"line {i}\n" for i in range(500)))
    dst = land_raw(spark, f"{root}/src/*.txt", f"{root}/extract", header=False)
    back = spark.read.option("recursiveFileLookup", True).text(f"{dst}/source=log.txt")
    assert sorted(r.value for r in back.collect()) == sorted(f"line {i}" for i in range(500))


def test_running_stream_load(spark):
    from corvid.streaming.incremental import start_stream_load
    root = scratch_dir(spark, "t-stream-run")
    _write(f"{root}/in/a.csv", "Year, Score\n2000, 1\n")
    q = start_stream_load(spark, f"{root}/in", f"{root}/out", "Year int, Score int", every="1 second",
                          checkpoint=f"{root}/ckpt")
    try:
        q.processAllAvailable()
        _write(f"{root}/in/b.csv", "Year, Score\n2001, 2\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.Year for r in read_parquet(spark, f"{root}/out").collect()) == [2000, 2001]

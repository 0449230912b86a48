"""Byte-exact landing (A10), atomic replace (A05), rejected lines (A11), stored splits (B13), resumed chains."""

from __future__ import annotations

import functools
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from corvid.plans.steps import load_step, rejected_of, run_pipeline, transform_step
from corvid.session import scratch_dir
from corvid.sources.files import read_csv, read_parquet, write_parquet
from corvid.sources.landing import land_files, manifest, verify_landing
from corvid.sources.rejects import accepted, read_csv_checked, rejected, write_split
from corvid.streaming.incremental import loaded, stream_load


def _write(path: str, data: bytes | str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


FILES = {"one/a.csv": b"k,v\r\n1,a\r\n2,b", "two x+y%/a.csv": random.Random(1).randbytes(700_001), "two x+y%/empty.csv": b"",
         "two x+y%/newline.csv": b"\n", "two x+y%/exact.csv": bytes(200_000)}


def test_landed_files_equal_their_sources(spark):
    root = scratch_dir(spark, "t-bytes")
    for name, data in FILES.items():
        _write(f"{root}/src/{name}", data)
    dst = land_files(spark, f"{root}/src/*/*", f"{root}/extract", range_bytes=100_000)
    assert {n: _read(f"{dst}/{n}") for n in FILES} == FILES
    parts = {r.source: (r.n, r.whole) for r in manifest(spark, dst).groupBy("source").agg(
        F.count("*").alias("n"), F.sum("length").alias("whole")).collect()}
    assert parts == {n: (max(1, -(-len(d) // 100_000)), len(d)) for n, d in FILES.items()}
    assert {r.source: (r.n_bytes, r.identical) for r in verify_landing(spark, dst).collect()} == {n: (len(d), True) for n, d in FILES.items()}
    assert [n for n in os.listdir(root) if n.startswith(".")] == []


def test_landing_is_checked_and_replaced_whole(spark):
    root = scratch_dir(spark, "t-bytes2")
    _write(f"{root}/src/a.csv", "k,v\n1,a\n")
    _write(f"{root}/src/b.csv", "k,v\n2,b\n")
    _write(f"{root}/src/c.csv", "k,v\n3,c\n")
    dst = land_files(spark, f"{root}/src/*.csv", f"{root}/extract")
    assert sorted(map(tuple, read_csv(spark, dst, recursive=True).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    _write(f"{dst}/a.csv", "k,v\n1,x\n")
    _write(f"{dst}/b.csv", "k,v\n2,b\n\n")
    os.remove(f"{dst}/c.csv")
    assert {r.source: r.identical for r in verify_landing(spark, dst).collect()} == dict.fromkeys(("a.csv", "b.csv", "c.csv"), False)
    os.remove(f"{root}/src/a.csv")
    land_files(spark, f"{root}/src/*.csv", dst)  # replaces all of it
    assert sorted(os.listdir(dst)) == ["_manifest", "b.csv", "c.csv"]


def test_landing_several_folders(spark):
    root = scratch_dir(spark, "t-bytes3")
    _write(f"{root}/p/x.txt", "1")
    _write(f"{root}/q/x.txt", "2")
    dst = land_files(spark, [f"{root}/p/x.txt", f"{root}/q/*.txt"], f"{root}/out")
    found = {r.source for r in manifest(spark, dst).collect()}
    assert len(found) == 2 and all(_read(f"{dst}/{n}") in (b"1", b"2") for n in found)


def test_a_failing_write_leaves_the_table(spark):
    dst = f"{scratch_dir(spark, 't-replace')}/t"
    write_parquet(spark.range(4), dst)
    bad = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_parquet(bad, dst)
    assert read_parquet(spark, dst).count() == 4
    write_parquet(read_parquet(spark, dst).where("id > 0"), dst)  # computed from what it replaces
    assert read_parquet(spark, dst).count() == 3
    assert os.listdir(os.path.dirname(dst)) == ["t"]


def test_an_interrupted_switch_is_put_back(spark):
    root = scratch_dir(spark, "t-switch")
    dst = write_parquet(spark.range(4), f"{root}/t/")
    os.rename(f"{root}/t", f"{root}/.t.old-0123456789ab")  # as a driver that ends between the renames leaves it
    with pytest.raises(Exception, match="broken"):
        write_parquet(spark.range(1).select(F.raise_error(F.lit("broken")).cast("int").alias("x")), dst)
    assert read_parquet(spark, dst).count() == 4


def test_partitioned_replace(spark):
    dst = f"{scratch_dir(spark, 't-part')}/t"
    df = spark.range(6).withColumn("p", F.col("id") % 2)
    write_parquet(df, dst, ["p"])
    assert sorted(n for n in os.listdir(dst) if n.startswith("p=")) == ["p=0", "p=1"]
    assert read_parquet(spark, dst).where("p = 1").count() == 3


LINES = 'k,n,s\n1, 1,a\n2,x,b\n3,4\n4,,c\n5,6,d,e\n6,2147483648,"f, g"\n7,7,"h, i"\n,y,\n'
SCHEMA = "k int, n int, `s` string"


def test_rejected_lines_have_file_and_reason(spark):
    root = scratch_dir(spark, "t-rejects")
    _write(f"{root}/in/f x.csv", LINES)
    df = read_csv_checked(spark, f"{root}/in", SCHEMA)
    assert sorted(map(tuple, accepted(df).collect())) == [(1, 1, "a"), (4, None, "c"), (7, 7, "h, i")]
    bad = {r.line: r for r in rejected(df).collect()}
    assert {k: r.reason for k, r in bad.items()} == {"2,x,b": "n is no int", "3,4": "fields", "5,6,d,e": "fields",
                                                     '6,2147483648,"f, g"': "n is no int", ",y,": "n is no int"}
    assert all(r.file.endswith("/in/f x.csv") for r in bad.values())


def test_checked_load_without_schema(spark):
    root = scratch_dir(spark, "t-rejects2")
    _write(f"{root}/in/a.csv", "k,v\n1,a\nx,b\n3\n")
    df = read_csv_checked(spark, f"{root}/in/a.csv")
    assert sorted(r.k for r in accepted(df).collect()) == ["1", "x"]
    assert [tuple(r)[1:] for r in rejected(df).collect()] == [("3", "fields")]


def test_load_step_sets_lines_aside(spark):
    root = scratch_dir(spark, "t-quarantine")
    _write(f"{root}/src/films.csv", "Year, Score, Title\n2000, 50, a\n2000, seventy, b\n1999, 10, c\n")
    src, schema = f"{root}/src/films.csv", "Year int, Score double, Title string"
    good = load_step(spark, src, root, schema, quarantine=True)
    assert good.endswith("/load/films/") and rejected_of(src, root).endswith("/rejected/films/")
    assert sorted((r.Year, r.Score) for r in read_parquet(spark, good).collect()) == [(1999, 10.0), (2000, 50.0)]
    assert [r.reason for r in rejected(read_parquet(spark, rejected_of(src, root))).collect()] == ["Score is no double"]
    out = transform_step(spark, good, root)
    assert sorted(map(tuple, read_parquet(spark, out).collect())) == [(1999, 10.0), (2000, 50.0)]
    _write(src, "Year, Score, Title\n2000, 50, a\n")  # nothing to reject: both sides are replaced
    load_step(spark, src, root, schema, quarantine=True)
    assert read_parquet(spark, good).count() == 1 and read_parquet(spark, rejected_of(src, root)).count() == 0
    assert load_step(spark, src, root, schema).endswith("/load/films/")  # without: values that do not parse are null


def test_a_split_is_computed_once(spark):
    root = scratch_dir(spark, "t-split")
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for b in rows:
            seen.add(b.num_rows)
            yield b
    df = spark.range(10).mapInArrow(count, "id long")
    good, bad = write_split(df, F.when(F.col("id") > 6, F.col("id") > 7), f"{root}/good", f"{root}/bad")
    assert seen.value == 10
    assert read_parquet(spark, good).count() == 8 and sorted(r.id for r in read_parquet(spark, bad).collect()) == [8, 9]


def test_stream_sets_lines_aside_once(spark):
    root = scratch_dir(spark, "t-stream-q")
    _write(f"{root}/in/a.csv", "Year,Score\n2000,1\nMM,2\n")
    args = dict(schema="Year int, Score int", checkpoint=f"{root}/ckpt", quarantine=True)
    dst = stream_load(spark, f"{root}/in", f"{root}/out", **args)
    _write(f"{root}/in/b.csv", "Year,Score\n2001,x\n2002,3\n")
    stream_load(spark, f"{root}/in", dst, **args)
    good, bad = loaded(spark, dst)
    assert good.columns == ["Year", "Score"] and sorted(map(tuple, good.collect())) == [(2000, 1), (2002, 3)]
    assert sorted((os.path.basename(r.file), r.line, r.reason) for r in bad.collect()) == [
        ("a.csv", "MM,2", "Year is no int"), ("b.csv", "2001,x", "Score is no int")]


def _traced(log: list, name: str, scale: int, fail: list, spark, uri, root):
    log.append(name)
    if fail and fail[0] == name:
        raise RuntimeError(name)
    return write_parquet(read_parquet(spark, uri).select((F.col("id") * scale).alias("id")), f"{root}/{name}")


def test_a_chain_goes_on_where_it_broke(spark, monkeypatch):
    root = scratch_dir(spark, "t-resume")
    src = write_parquet(spark.range(3), f"{root}/src")
    log, fail = [], ["b"]

    def step(name, scale=2):
        def run(spark, uri, root, scale=scale):
            return _traced(log, name, scale, fail, spark, uri, root)
        run.__qualname__ = f"run_{name}"
        return run

    def go(*steps):
        log.clear()
        return sorted(r.id for r in run_pipeline(spark, steps, src, root, resume=True).collect())
    with pytest.raises(RuntimeError):
        go(step("a"), step("b"), step("c"))
    assert log == ["a", "b"]
    fail.clear()
    assert go(step("a"), step("b"), step("c")) == [0, 8, 16] and log == ["b", "c"]
    assert go(step("a"), step("b"), step("c")) == [0, 8, 16] and log == []
    assert go(step("a"), step("b", 3), step("c")) == [0, 12, 24] and log == ["b", "c"]  # other arguments
    assert go(step("a"), step("b", 3), functools.partial(step("c"), scale=5)) == [0, 30, 60] and log == ["c"]
    time.sleep(0.01)
    write_parquet(spark.range(4), src)  # changed input reruns all
    assert go(step("a"), step("b", 3), step("c")) == [0, 12, 24, 36] and log == ["a", "b", "c"]
    write_parquet(spark.range(1), f"{root}/b")  # an output that is not what was recorded
    assert go(step("a"), step("b", 3), step("c")) == [0, 12, 24, 36] and log == ["b", "c"]
    assert sorted(r.id for r in run_pipeline(spark, [step("a"), step("b", 3), step("c")], src, root).collect()) == [0, 12, 24, 36]

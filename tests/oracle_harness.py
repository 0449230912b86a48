"""Run registered queries on Spark and their SQL twins on DuckDB, and compare
row count, column names and order-insensitive values.

    python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, Decimal):
        return str(int(v)) if v == v.to_integral_value() else f"{float(v):.9g}"
    if isinstance(v, (datetime, date)):
        return v.isoformat(sep=" ") if isinstance(v, datetime) else v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of(cols: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "smallint": "SMALLINT",
                 "tinyint": "TINYINT", "float": "FLOAT"}


def _duck_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_types = dict(spark_df.dtypes)
    s_rows = [tuple(r) for r in spark_df.collect()]
    d = con.sql(sql)
    d_cols = d.columns
    d_types = {c: str(t).replace(" ", "") for c, t in zip(d.columns, d.types)}
    d_rows = d.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if _duck_type(s_types[c]) != d_types[c]}
    if bad_types:
        return False, f"types differ: {bad_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ (sorted cols {sorted(s_cols)}): {diff}"
    return True, f"{len(s_rows)} rows"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from corvid.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(queries())
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            if k in sqls:
                ok, msg = compare(df, con, sqls[k])
            else:
                ok, msg = True, f"rows-only: {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k:28s} {time.time() - t0:6.1f}s  {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

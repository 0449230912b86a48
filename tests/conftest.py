from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corvid.session import build_session, clean_scratch
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    clean_scratch(s)


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_SMALL


def one_col(spark, values, ddl="s string"):
    return spark.createDataFrame([(v,) for v in values], ddl)

"""Every registered query against its SQL in DuckDB."""

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from tests.conftest import TESTDATA
from veraz.plans import catalogue, domain

BIG = TESTDATA.replace("0.001", "0.01")


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, Decimal)):
        return "nan" if math.isnan(v) else round(float(v), 6) + 0.0
    if isinstance(v, datetime):
        return v.isoformat()
    return v.isoformat() if isinstance(v, date) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in (*domain.TABLES, "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{BIG}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, BIG)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in catalogue.ORACLE_SQL:
        assert got
        return
    result = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in result.fetchall())
    assert sum(got.values()) == sum(want.values())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])

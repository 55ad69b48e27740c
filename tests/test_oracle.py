"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import datetime as dt
import decimal
import math
from collections import Counter

import pytest

import __spark_entry__ as E
from candlewick.plans.oracle import ORACLE_SQL
from candlewick.plans.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["customer", "orders", "events", "lineitem", "nation", "region", "supplier", "part"]


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("f", v)
    if isinstance(v, decimal.Decimal):
        return ("d", v)
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return ("y", bytes(v))
    return (type(v).__name__, v)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert op not in plan, f"{key} plans {op}"
    rows, cols = df.collect(), df.columns
    rel = duck.sql(E.oracle_sql()[key])
    drows, dcols = rel.fetchall(), rel.columns
    assert sorted(cols) == sorted(dcols)
    oi = sorted(range(len(cols)), key=lambda i: cols[i])
    od = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = Counter(tuple(_norm(r[i]) for i in oi) for r in rows)
    b = Counter(tuple(_norm(r[i]) for i in od) for r in drows)
    assert a == b


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLE_SQL) <= set(E.queries()) & set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 397
    assert df.filter("vwap is null").count() == 1

"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from clinilake.plans import catalog
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(got, df.columns) == _canon(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 13 and df.count() > 0


def test_oracles_tell_wrong_answers(spark, duck):
    """The gap oracle rejects the formula that counts rows without a date."""
    from clinilake.plans.catalog import _FAULTY, _mean_gap_sql
    right = duck.execute(_mean_gap_sql(_FAULTY, "customer", "day")).fetchall()
    wrong = duck.execute(f"""
        select customer, count(*), min(day), max(day), datediff('day', min(day), max(day)) / (count(*) - 1)
        from ({_FAULTY}) group by customer having count(*) > 1""").fetchall()
    means = {r[0]: r[4] for r in right}
    assert any(means[r[0]] != r[4] for r in wrong)

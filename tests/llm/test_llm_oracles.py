"""The operators' queries against DuckDB, and their registration."""

import duckdb
import pytest

import __spark_entry__ as entry
from clinilake.llm import queries
from conftest import SF_SMALL
from test_oracle import TABLES, _canon


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_operator_has_one_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(queries.ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert _canon(got, df.columns) == _canon(res.fetchall(), columns)

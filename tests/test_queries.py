"""Every query against its plain SQL on the smallest data folder."""

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as contract
from tidemark.bindings import SOURCES
from tidemark.oracles import ORACLES
from tidemark.queries import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def value(v):
    return round(v, 6) if isinstance(v, float) else v


def counted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(r[i]) for i in order) for r in data)


def test_every_query_has_its_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    result = database.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    expected = counted(columns, result.fetchall())
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    assert counted(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0

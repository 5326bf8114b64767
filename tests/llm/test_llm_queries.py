"""Registered queries against plain SQL, and that all of them run."""

from collections import Counter
from pathlib import Path

import pytest

from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
duckdb = pytest.importorskip("duckdb")


def value(v):
    return round(v, 6) if isinstance(v, float) else v


def counted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    assert counted(df.columns, df.collect()) == counted(columns, result.fetchall())


# Queries with other rows than one per document or page have tests of their own.
OTHER_ROWS = {"op11_whitening", "op12_spelling"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OTHER_ROWS))
def test_rows_for_every_document(spark, name):
    table = "pages" if name == "op9_warc" else "documents"
    assert QUERIES[name](spark, DATA).count() == spark.read.parquet(f"{DATA}/{table}.parquet").count()


def test_minhash_query_against_brute_force(spark):
    from tests.llm.test_minhash import expected

    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert Counter(map(tuple, QUERIES["op13_minhash"](spark, DATA).collect())) == expected(rows)


def test_spelling_query_against_brute_force(spark):
    from tests.llm.test_spelling import brute, result

    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert result(QUERIES["op12_spelling"](spark, DATA)) == brute(rows)


def test_whitening_query_against_brute_force(spark):
    from tests.llm.test_whitening import check

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert check(QUERIES["op11_whitening"](spark, DATA).collect(), rows, 64) == 32

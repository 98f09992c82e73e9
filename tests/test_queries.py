"""Every registered query against its SQL statement, on the smallest tables."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from whosaid.workloads.oracles import ORACLES
from whosaid.workloads.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_entry(spark):
    df = entry(spark)
    assert df.columns == [
        "articleUID",
        "content",
        "content_size",
        "quotation",
        "quotation_size",
    ]


def test_statements_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns, got = check.rows_of(df.columns, map(tuple, df.collect()))
    assert got
    relation = duck.sql(ORACLES[name])
    expected = check.rows_of(relation.columns, relation.fetchall())
    assert (columns, got) == expected

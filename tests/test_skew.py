"""Every query on tables in which one key has a third of the rows."""

import duckdb
import pytest

import check
from __spark_entry__ import oracle_sql, queries
from whosaid.operators import skew
from whosaid.workloads.adapters import write_skewed_copy

NAMES = (
    "tag_corpus",
    "extract_articles",
    "map_discarded",
    "ingest_entries_distinct",
    "join_articles",
    "join_mapping",
    "join_speakers",
    "dedupe_pairs",
    "dedupe_content",
    "clean_html_tokens",
)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    write_skewed_copy(spark, "/root/testdata/sf0.001", folder, copies=6)
    duck = duckdb.connect()
    for name in ("documents", "conversations", "pages"):
        duck.sql(
            f"CREATE VIEW {name} AS "
            f"SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')"
        )
    return folder, duck


def test_the_copy_is_skewed(skewed):
    _, duck = skewed
    for sql in (
        "SELECT avg(CAST(text = '' AS INT)) FROM documents",
        "SELECT avg(CAST(conv_id = 5 AS INT)) FROM conversations",
    ):
        ((share,),) = duck.sql(sql).fetchall()
        assert share > 0.32


@pytest.fixture(params=["small tables", "large tables"])
def either_way(request, spark, monkeypatch):
    """Small tables may be broadcast; of large ones Spark broadcasts none."""
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    if request.param == "large tables":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, skewed, either_way, name):
    folder, duck = skewed
    df = queries()[name](spark, folder)
    columns, got = check.rows_of(df.columns, map(tuple, df.collect()))
    relation = duck.sql(oracle_sql()[name])
    assert (columns, got) == check.rows_of(relation.columns, relation.fetchall())

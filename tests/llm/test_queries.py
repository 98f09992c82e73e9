"""Registered queries against their SQL, and the pipeline against its stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import check
import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm import plain
from whosaid.llm.queries import ORACLES, QUERIES
from whosaid.llm.tables import stored

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert ORACLES.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    columns, got = check.rows_of(df.columns, map(tuple, df.collect()))
    assert got
    if name in ORACLES:
        duck = duckdb.connect()
        for table in ("documents", "benchmark", "conversations"):
            duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        relation = duck.sql(ORACLES[name])
        assert (columns, got) == check.rows_of(relation.columns, relation.fetchall())


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    kept = stored(stages["quality classifier"](spark, docs, sf))
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == columns
    right = sum((i in ids) == (q == 1) for i, q in labels.items())
    assert right >= 0.97 * len(labels)

    single = stored(stages["n-gram Jaccard join"](spark, kept, sf))
    texts = {r.doc_id: r.text for r in kept.collect()}
    group = plain.components({i: plain.shingles(t, 5) for i, t in texts.items() if len(t) < 4000}, 80)
    left = {r.doc_id for r in single.collect()}
    assert single.columns == columns
    assert all((i in left) == (c == i) for i, c in group.items())

    clean = stored(stages["benchmark decontamination"](spark, single, sf))
    rows = [(r.doc_id, r.text) for r in single.collect()]
    hit = plain.contamination([t for _, t in rows], bench, 10)
    want = {i for (i, _), (_, n, _) in zip(rows, hit) if n == 0}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == want

    mixture = stored(stages["mixing to target weights"](spark, clean, sf))
    assert mixture.columns == columns
    tokens = "sum((octet_length(text) + 3) div 4) as n"
    before, after = (d.selectExpr(tokens).first().n for d in (clean, mixture))
    # Each leaf may end up to one document short.
    assert 0.85 * before <= after <= before

    last = stages["sharding"](spark, mixture, sf).collect()
    assert len(last) == mixture.count()
    size = [sum(r.size for r in last if r.shard == s) for s in range(8)]
    assert max(size) <= 1.1 * min(size)


@pytest.mark.parametrize("as_table", [True, False])
def test_stages_decide_by_row(spark, as_table):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first().text
    near = " ".join(f"n{i}" for i in range(100))
    rows = [
        (3, "one two three"), (3, "one two three"), (3, "one two three"),
        (None, "four five six"), (None, "four five six"), (None, "one two three"),
        (5, near + " x"), (4, near + " y"), (None, near + " z"), (4, near + " y"), (6, near),
        (7, "seven"), (7, "eight"), (8, None), (8, ""), (None, ""),
        (9, "w " + bench), (9, "clean nine"), (None, "v " + bench + " v v v v v v v v v v v v v v"),
        (None, "clean none"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = stored(docs.repartition(3)) if as_table else docs
    stages = dict(corpus_pipeline.STAGES)

    def listed(df):
        return sorted(map(tuple, df.collect()), key=repr)

    clean = listed(stages["benchmark decontamination"](spark, docs, SF))
    assert clean == sorted((r for r in rows if bench not in (r[1] or "")), key=repr)
    single = listed(stages["n-gram Jaccard join"](spark, docs, SF))
    assert [r for r in single if bench not in (r[1] or "")] == sorted([
        (3, "one two three"), (None, "four five six"), (4, near + " y"), (7, "seven"),
        (7, "eight"), (8, None), (8, ""), (None, ""), (9, "clean nine"), (None, "clean none"),
    ], key=repr)


@pytest.mark.parametrize("as_table", [True, False])
def test_stages_with_columns_of_any_name(spark, as_table):
    names = [n for n in plain.CLASHING if n not in ("score", "text")]
    names += ["score", "_row", "_measured", "_metadata", "doc", "tokens_", "a.b"]
    texts = ["Plain words that say something, here and there.", None, "", "one two three", "one two three"]
    docs = plain.frame(spark, texts).drop(*plain.CLASHING)
    docs = docs.withColumns({n: F.lit(i) for i, n in enumerate(names)})
    docs = stored(docs) if as_table else docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        assert all(r["_metadata"] == names.index("_metadata") for r in got.collect()), name
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, docs, SF).count() == docs.count()


def test_stages_of_an_empty_table(spark):
    docs = plain.empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == [], name


def test_run_is_its_stages(spark):
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    rows = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
    assert sorted(rows.collect()) == sorted(docs.collect())

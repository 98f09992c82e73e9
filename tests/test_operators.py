from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from whosaid.operators.articles import (
    cast_id,
    explode_occurrences,
    filter_publisher,
    repartition_rows,
    sample_rows,
)
from whosaid.operators.dedupe import dedupe_content, dedupe_pairs, one_per_article
from whosaid.operators.entries import normalize_entries
from whosaid.operators.joins import join_articles, join_mapping, join_speakers
from whosaid.operators.metrics import RunMetrics
from whosaid.operators.skew import key_parts, spread_join
from whosaid.plans.ingest import ingest_entries
from whosaid.plans.tagging import tag_corpus
from whosaid.schemas import ATTRIBUTIONS, RAW
from whosaid.sources.sinks import write_json
from whosaid.workloads import adapters

ENTRY = "permalinkEntry struct<identifier string, tokenizedContent array<string>>, note string"


def entry(identifier, tokens, note=""):
    return (Row(identifier=identifier, tokenizedContent=tokens), note)


def kept(df):
    return sorted(r.permalinkEntry.identifier for r in df.collect())


def rows(df):
    names = sorted(df.columns)
    return Counter(tuple(str(r[n]) for n in names) for r in df.collect())


def test_cast_id(spark):
    df = spark.createDataFrame([("12",), ("abc",), ("",), (None,)], "i string")
    assert [r.x for r in df.select(cast_id(F.col("i")).alias("x")).collect()] == [
        12,
        None,
        None,
        None,
    ]


def test_filter_publisher(spark):
    df = spark.createDataFrame(
        [(Row(publisherType=t),) for t in ("NEWS", "news", "FORUM", None)],
        "source struct<publisherType string>",
    )
    assert filter_publisher(df, []).count() == 4
    assert filter_publisher(df, ["NEWS"]).count() == 1
    assert filter_publisher(df, ["NEWS", "FORUM"]).count() == 2


def test_sample_rows(spark):
    df = spark.range(20_000)
    key = F.col("id")
    assert sample_rows(df, 1.0, 1, key) is df
    keyed = sample_rows(df, 0.2, 1, key)
    assert 3_600 < keyed.count() < 4_400
    for parts in (1, 4, 16):
        moved = sample_rows(df.repartition(parts), 0.2, 1, key)
        assert keyed.exceptAll(moved).count() == 0 == moved.exceptAll(keyed).count()
    assert sample_rows(df, 0.2, 2, key).exceptAll(keyed).count() > 0
    nulls = spark.createDataFrame([(None,)] * 3, "id string")
    assert {sample_rows(nulls, 0.5, s, key).count() for s in range(20)} == {0, 3}


def test_sampled_jobs_do_not_depend_on_partitions(spark):
    entries = adapters.entries(spark, "/root/testdata/sf0.001")
    raw = adapters.raw_records(spark, "/root/testdata/sf0.001")
    found = set()
    for parts in (1, 4, 16):
        tagged = tag_corpus(entries.repartition(parts), fraction=0.3, seed=3)
        kept = ingest_entries(raw.repartition(parts), fraction=0.3, seed=3, clean=False)
        found.add(
            (
                frozenset(r.articleUID for r in tagged.select("articleUID").collect()),
                frozenset(r[0] for r in kept.select("feedEntry.identifier").collect()),
            )
        )
    assert len(found) == 1 and all(found.pop())


def test_an_absent_publisher_is_the_empty_one(spark):
    raw = adapters.raw_records(spark, "/root/testdata/sf0.001")
    blank = raw.withColumn("source", F.col("source").dropFields("publisherType"))
    blank = adapters.filled(blank, RAW)
    n = raw.count()
    for wanted, rows in ((["src0"], 0), ([""], n), (["", "src0"], n)):
        before = ingest_entries(blank, types=wanted, clean=False, tokenize=False)
        after = filter_publisher(normalize_entries(blank, False, False), wanted)
        assert before.count() == after.count() == rows


def test_repartition_rows(spark):
    df = spark.range(100)
    assert repartition_rows(df, 0) is df
    assert rows(repartition_rows(df, 7)) == rows(df)


def test_explode_occurrences(spark):
    seen = Row(articleUID="1", quotation="q", extractedBy="p", patternConfidence=0.5)
    df = spark.createDataFrame(
        [("a", "c", [seen, seen]), ("b", "c", []), ("d", "c", None)], ATTRIBUTIONS
    )
    assert explode_occurrences(df).count() == 2
    assert explode_occurrences(df, True).columns == [
        "canonicalQuotation",
        "articleUID",
        "quotation",
        "extractedBy",
        "patternConfidence",
        "speaker",
    ]


# Joins. A third of the rows has one key; the limits are set low, so that the
# hot path runs on little data.


@pytest.fixture(scope="module")
def skewed(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 500 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40))
        .alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(90).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 31 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id")))
        .alias("k"),
        F.lit("copy").alias("r"),
    )
    return left, right


def test_key_parts(spark, skewed):
    left, _ = skewed
    parts = {r["_key"]: r["_parts"] for r in key_parts(left, "k", hot_rows=100).collect()}
    assert parts["hot"] == 10 and set(parts) == {
        r.k for r in left.select("k").dropna().distinct().collect()
    }
    assert sum(p > 1 for p in parts.values()) == 1
    assert key_parts(left.limit(0), "k").collect() == []


@pytest.mark.parametrize("left_is_hot", [False, True])
@pytest.mark.parametrize("hot_rows", [None, 50, 5])
def test_spread_join_gives_the_plain_join(skewed, left_is_hot, hot_rows):
    left, right = skewed
    right = right.withColumnRenamed("k", "k2")
    joined = spread_join(left, right, "k", "k2", hot_rows, left_is_hot)
    plain = left.join(right, F.col("k") == F.col("k2"))
    assert joined.columns == plain.columns
    assert rows(joined) == rows(plain)


def test_spread_join_prepares_what_has_a_partner(skewed):
    left, right = skewed
    for hot_rows in (None, 20):
        joined = spread_join(
            right, left, "k", "k", hot_rows, prepare=lambda df: df.withColumn("made", F.upper("k"))
        )
        plain = right.withColumn("made", F.upper("k")).join(left, "k")
        assert rows(joined) == rows(plain)


def test_spread_join_uses_many_tasks_for_a_hot_key(spark, skewed):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        hot_right = right.where("k = 'hot'").limit(1)

        def tasks(hot_rows):
            joined = spread_join(hot_right, left, "k", "k", hot_rows)
            return (
                joined.withColumn("task", F.spark_partition_id())
                .groupBy("task")
                .count()
                .collect()
            )

        assert len(tasks(None)) == 1
        spread = tasks(20)
        assert len(spread) > 4
        assert sum(r["count"] for r in spread) == 1000
        assert max(r["count"] for r in spread) < 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_spread_join_parts_do_not_depend_on_row_order(skewed):
    left, right = skewed
    once = spread_join(right, left.repartition(5, "l"), "k", "k", 20)
    again = spread_join(right, left.orderBy(F.desc("l")).repartition(5, "l"), "k", "k", 20)
    assert rows(once) == rows(again)


def test_spread_join_wants_keys_of_one_type(skewed):
    left, right = skewed
    with pytest.raises(TypeError):
        spread_join(left, right, "l", "k")


def test_named_joins(spark):
    articles = spark.createDataFrame(
        [("1", ["a"]), ("x", ["b"]), (None, ["c"]), ("1", ["d"])],
        "articleUID string, content array<string>",
    )
    seen = spark.createDataFrame(
        [("1", "q"), ("1", "q"), ("x", "q"), (None, "q"), ("9", "q")],
        "articleUID string, quotation string",
    )
    assert join_articles(articles, seen).count() == 5
    links = spark.createDataFrame(
        [(1, "d", 0.5, "s"), (None, "d", 0.5, "s"), (2, "d", 0.5, "s")],
        "articleUID bigint, canonicalQuotationDestination string, "
        "confidence double, canonicalQuotationSource string",
    )
    joined = join_mapping(articles, links)
    assert joined.schema["articleUID"].dataType.simpleString() == "bigint"
    assert joined.count() == 2
    quotations = spark.createDataFrame(
        [("d", "s1"), ("D", "s2"), (None, "s3")],
        "canonicalQuotation string, speaker string",
    )
    assert join_speakers(quotations, links).count() == 3


# Duplicates.


def test_dedupe_content(spark):
    df = spark.createDataFrame(
        [
            entry("10", ["a", "b"]),
            entry("9", ["a", "b"]),
            entry("x", ["a", "b"]),
            entry("7", ["a b"]),
            entry("6", ["a", "b", ""]),
            entry("5", []),
            entry("4", []),
            entry("3", None),
        ],
        ENTRY,
    )
    assert kept(dedupe_content(df)) == ["3", "6", "7", "9"]
    assert kept(dedupe_content(df, keep_empty=True)) == ["3", "4", "5", "6", "7", "9"]


def test_dedupe_content_keeps_one_of_equal_ids(spark):
    df = spark.createDataFrame(
        [entry("1", ["a"], note) for note in "abcdef"] + [entry("x", ["b"])] * 3, ENTRY
    )
    once = rows(dedupe_content(df.repartition(1)))
    assert once.total() == 2
    assert rows(dedupe_content(df.repartition(6))) == once


def test_dedupe_combines_before_the_shuffle(spark):
    df = spark.range(9000).select(
        F.struct(
            F.col("id").cast("string").alias("identifier"),
            F.when(F.col("id") % 3 == 0, F.array().cast("array<string>"))
            .otherwise(F.array(F.col("id").cast("string")))
            .alias("tokenizedContent"),
        ).alias("permalinkEntry")
    )
    out = dedupe_content(df)
    assert out.count() == 6001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange")


def test_dedupe_pairs(spark):
    df = spark.createDataFrame(
        [
            (1, "s", "q", 0.2, ["b"]),
            (1, "s", "q", 0.9, ["a"]),
            (1, None, "q", 0.1, ["a"]),
            (1, None, "q", None, ["a"]),
            (2, "s", "q", 0.3, None),
        ],
        "articleUID bigint, speaker string, quotation string, "
        "confidence double, content array<string>",
    )
    out = {(r.articleUID, r.speaker): (r.confidence, r.content) for r in dedupe_pairs(df).collect()}
    assert out == {
        (1, "s"): (0.9, ["a"]),
        (1, None): (0.1, ["a"]),
        (2, "s"): (0.3, None),
    }
    assert dedupe_pairs(df.drop("content")).count() == 3
    assert one_per_article(df).count() == 2


def test_dedupe_pairs_joins_articles_to_what_remains(spark):
    pairs = spark.range(4000).selectExpr(
        "id % 4 AS articleUID", "'s' AS speaker", "'q' AS quotation", "id / 4000 AS confidence"
    )
    articles = spark.createDataFrame(
        [("1", ["b"]), ("1", ["a"]), ("2", ["c"]), ("x", ["d"]), (None, ["e"]), ("9", ["f"])],
        "articleUID string, content array<string>",
    )
    out = dedupe_pairs(pairs, articles)
    assert {tuple(map(str, r)) for r in out.collect()} == {
        ("1", "s", "q", "0.99925", "['a']"),
        ("2", "s", "q", "0.9995", "['c']"),
    }
    # Contents are in no row of the table that is aggregated by pair.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate" in line and "speaker" in line]


# Entries and metrics.


def test_normalize_an_empty_record(spark):
    df = spark.createDataFrame([(None, None, None, None)], RAW)
    row = normalize_entries(df).first()
    assert row.source.publisherType == "" and row.feed.channelUrl == ""
    assert row.feedEntry.identifier == "0"
    assert row.permalinkEntry.authorName == ""
    assert row.permalinkEntry.tokenizedContent == []


def test_run_metrics(spark):
    run = RunMetrics()
    watched = run.watch(spark.range(1234), even=F.col("id") % 2 == 0)
    watched.write.format("noop").mode("overwrite").save()
    report = run.report()
    assert (report["documents"], report["even"]) == (1234, 617)
    assert report["documents_per_second"] > 0

    run = RunMetrics()
    run.watch(spark.range(0)).write.format("noop").mode("overwrite").save()
    assert run.report()["ms_per_document"] is None


def test_parts_grow_in_number_with_their_rows(spark, tmp_path):
    rows = spark.range(25_000)
    assert repartition_rows(rows, 1).rdd.getNumPartitions() == 3
    assert repartition_rows(rows, 5).rdd.getNumPartitions() == 5
    assert repartition_rows(rows.limit(0), 2).count() == 0
    assert repartition_rows(rows, 1).distinct().count() == 25_000
    write_json(rows, f"{tmp_path}/out", partitions=2)
    assert len(list((tmp_path / "out").glob("part-*"))) == 3
    assert spark.read.json(f"{tmp_path}/out").distinct().count() == 25_000

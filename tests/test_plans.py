import re
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests import plain
from whosaid.operators.articles import (
    explode_occurrences,
    occurrence_ids,
    project_articles,
)
from whosaid.plans.extract import extract_articles
from whosaid.plans.ingest import ingest_entries
from whosaid.plans.mapping import map_discarded, mapped_pairs
from whosaid.plans.tagging import tag_corpus
from whosaid.schemas import ATTRIBUTIONS, ENTRY, MAPPING
from whosaid.workloads import adapters

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made_entries(spark, articles):
    df = spark.createDataFrame(articles, "id string, tokens array<string>")
    return df.select(
        F.struct(F.col("id").alias("identifier")).alias("feedEntry"),
        F.struct(F.col("tokens").alias("tokenizedContent")).alias("permalinkEntry"),
    )


def seen(article, quotation="He said so-so", by="p", confidence=0.5):
    return Row(
        articleUID=article,
        quotation=quotation,
        extractedBy=by,
        patternConfidence=confidence,
    )


# What the plans look like.


def test_tagging_computes_an_article_once(spark):
    df = tag_corpus(adapters.entries(spark, SF))
    plan = optimized(df)
    # Once per place in the repair rule that splits a token at its dashes.
    assert plan.count("regexp_replace") == 2
    assert plan.count("inline(") == 1
    assert "Filter" not in plan


def test_tagging_does_not_shuffle(spark, tmp_path):
    adapters.entries(spark, SF).write.parquet(f"{tmp_path}/e")
    df = tag_corpus(spark.read.parquet(f"{tmp_path}/e"))
    plan = executed(df)
    assert "Exchange" not in plan and "Python" not in plan


def test_scans_read_only_the_needed_fields(spark, tmp_path):
    adapters.entries(spark, SF).write.parquet(f"{tmp_path}/e")
    entries = spark.read.parquet(f"{tmp_path}/e")
    plan = executed(project_articles(entries))
    assert (
        "ReadSchema: struct<feedEntry:struct<identifier:string>,"
        "permalinkEntry:struct<tokenizedContent:array<string>>>" in plan
    )
    raw = adapters.raw_records(spark, SF)
    plan = executed(ingest_entries(raw, types=["src0"]))
    assert "PushedFilters: [In(source, [src0])]" in plan or "EqualTo(source,src0)" in plan


def test_ids_are_read_alone(spark, tmp_path):
    attributions = adapters.attributions(spark, SF)
    attributions.write.parquet(f"{tmp_path}/a")
    ids = occurrence_ids(spark.read.parquet(f"{tmp_path}/a"))
    assert "ReadSchema: struct<occurrences:array<struct<articleUID:string>>>" in (
        executed(ids.groupBy("articleUID").count())
    )
    all_rows = explode_occurrences(attributions).select("articleUID")
    assert sorted(ids.collect()) == sorted(all_rows.collect())


def test_jobs_stay_in_the_jvm(spark):
    entries = adapters.entries(spark, SF)
    attributions = adapters.attributions(spark, SF)
    for df in (
        extract_articles(entries, attributions),
        map_discarded(entries, attributions, adapters.mapping(spark, SF)),
    ):
        assert "Python" not in executed(df)
        assert "Cartesian" not in executed(df) and "NestedLoop" not in executed(df)


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_articles_move_once_and_are_repaired_once(spark, tmp_path, hot_rows):
    adapters.entries(spark, SF).write.parquet(f"{tmp_path}/e")
    entries = spark.read.parquet(f"{tmp_path}/e")
    attributions = adapters.attributions(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            extract_articles(entries, attributions, hot_rows=hot_rows),
            map_discarded(entries, attributions, adapters.mapping(spark, SF), hot_rows=hot_rows),
        ):
            df.collect()
            plan = executed(df).split("== Initial Plan ==")[0].splitlines()
            scans = [i for i, line in enumerate(plan) if "FileScan parquet [feedEntry" in line]
            # Cold and hot articles share one scan and its one exchange.
            assert len(scans) == 1
            assert sum("Exchange" in plan[i] for i in above(plan, scans[0])) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def above(plan, i):
    """The lines of a node's parents."""
    depth = [len(re.match(r"[\s:|+-]*", line)[0]) for line in plan]
    at = depth[i]
    for j in range(i - 1, -1, -1):
        if depth[j] < at:
            at = depth[j]
            yield j


def test_duplicates_are_chosen_by_narrow_rows(spark):
    raw = adapters.raw_records(spark, SF)
    plan = executed(ingest_entries(raw, dedupe=True))
    assert "SortAggregate" not in plan and "Sort [" not in plan
    assert "ShuffledHashJoin" in plan and "partial_min_by" in plan
    # The permalink was inflated when the records were stored; what is left is the
    # other body, of the records that stay.
    assert plan.count("ArrowEvalPython") == 1 and "contentExtract" not in plan


def test_no_token_list_is_aggregated(spark):
    raw = adapters.raw_records(spark, SF)
    plan = executed(ingest_entries(raw, dedupe=True))
    sums = [line for line in plan.splitlines() if "Aggregate" in line]
    assert sums and not any("tokenizedContent" in line for line in sums)


# What the jobs give, on small made inputs with a hot key.


@pytest.fixture(params=["small tables", "large tables"])
def either_way(request, spark):
    """Runs a test as on small tables, and without any broadcast."""
    if request.param == "large tables":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_extract(spark, either_way):
    entries = made_entries(
        spark,
        [("1", ["a-b", "<p>", "c"]), ("1", ["twice"]), ("2", ["x"]), (None, ["n"])],
    )
    occurrences = [seen("1", confidence=i / 10) for i in range(8)] + [
        seen("2"),
        seen("9"),
        seen(None),
    ]
    attributions = spark.createDataFrame(
        [("s", "c", occurrences), ("t", "c", []), (None, "c", [seen("2")])],
        ATTRIBUTIONS,
    )
    rows = extract_articles(entries, attributions, hot_rows=3).collect()
    found = Counter(
        (r.articleUID, r.speaker, r.patternConfidence, tuple(r.content)) for r in rows
    )
    expected = Counter()
    for i in range(8):
        expected[("1", "s", i / 10, ("a", "-", "b", "c"))] += 1
        expected[("1", "s", i / 10, ("twice",))] += 1
    expected[("2", "s", 0.5, ("x",))] += 1
    expected[("2", None, 0.5, ("x",))] += 1
    assert found == expected
    assert {tuple(r.quotation) for r in rows} == {("He", "said", "so", "-", "so")}


def test_map(spark, either_way):
    entries = made_entries(
        spark,
        [("1", ["z"]), ("1", ["b-c"]), ("2", ["x"]), ("no number", ["n"]), (None, [])],
    )
    attributions = spark.createDataFrame(
        [
            ("s", "hot", [seen("7")] * 5),
            ("t", "hot", [seen(None)]),
            (None, "hot", [seen("7")]),
            ("u", "hot", []),
            ("v", "hot", None),
            ("w", "Hot", [seen("7")]),
        ],
        ATTRIBUTIONS,
    )
    mapping = spark.createDataFrame(
        [(1, "hot", c / 10, f"said {i}") for i in range(6) for c in (1, 9, 3)]
        + [(2, "hot", 0.5, "said"), (3, "hot", 0.5, "said"), (None, "hot", 0.5, "x")]
        + [(2, "cold", 0.5, "said"), (2, None, 0.5, "said")],
        MAPPING,
    )
    pairs = mapped_pairs(attributions, mapping, hot_rows=2)
    assert pairs.count() == 3 * (6 + 2)
    rows = map_discarded(entries, attributions, mapping, hot_rows=2).collect()
    found = Counter(
        (r.articleUID, r.speaker, r.confidence, tuple(r.content), tuple(r.quotation))
        for r in rows
    )
    expected = Counter()
    for speaker in ("s", "t", None):
        for i in range(6):
            said = ("said", str(i))
            expected[(1, speaker, 0.9, ("b", "-", "c"), said)] = 1
        expected[(2, speaker, 0.5, ("x",), ("said",))] = 1
    assert found == expected


def test_tag_corpus(spark):
    tokens = ["<p>", "-LRB-", "``", *"abcdefgh", "''", "end", "<q>", *"12345678", "</q>"]
    entries = made_entries(spark, [("1", tokens), ("2", ["x"]), ("3", []), ("4", None)])
    fixed = plain.repair(tokens, bracket_ends=False)
    spans = plain.spans(fixed)
    assert len(spans) == 2
    found = [(r.articleUID, r.content, r.quotation) for r in tag_corpus(entries).collect()]
    assert sorted(found) == sorted(("1", *plain.tag(fixed, spans, s)) for s in spans)


def test_tag_corpus_of_a_sample(spark):
    entries = made_entries(
        spark, [(str(i), ["``", *"abcdefgh", "''"]) for i in range(2000)]
    ).repartition(4)
    assert tag_corpus(entries).count() == 2000
    part = tag_corpus(entries, fraction=0.2, seed=3)
    assert 250 < part.count() < 550


def test_schemas(spark):
    empty = spark.createDataFrame([], ENTRY)
    assert project_articles(empty).columns == ["articleUID", "content"]
    tagged = tag_corpus(empty)
    assert tagged.schema.simpleString() == (
        "struct<articleUID:string,content:array<string>,quotation:array<string>>"
    )


# Articles of one id that are very many.


@pytest.fixture
def many_of_one_id(spark):
    entries = spark.range(100_000).select(
        F.struct(F.when(F.col("id") < 99_000, "1").otherwise(F.col("id").cast("string")).alias("identifier")).alias("feedEntry"),
        F.struct(F.array(F.lit("c-d"), (F.col("id") % 7).cast("string")).alias("tokenizedContent")).alias("permalinkEntry"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    yield entries.repartition(16)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def largest_part(df):
    """Rows of the largest task that joins articles to the ids."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_articles_of_a_hot_id_are_dealt(spark, many_of_one_id):
    attributions = spark.createDataFrame(
        [("s", "c", [seen("1"), seen("99500"), seen("x")])], ATTRIBUTIONS
    )
    plain = extract_articles(many_of_one_id, attributions)
    dealt = extract_articles(many_of_one_id, attributions, hot_rows=10_000, repeated_ids=True)
    assert plain.count() == 99_001 and largest_part(plain) == 99_000
    # Dealt by hash: parts are even but for chance.
    assert largest_part(dealt) <= 1.25 * 10_000
    columns = ["articleUID", "content", "speaker", "quotation"]
    assert dealt.groupBy(columns).count().exceptAll(plain.groupBy(columns).count()).count() == 0
    assert dealt.count() == 99_001


def test_map_chooses_over_the_parts_of_a_hot_id(spark, many_of_one_id):
    attributions = spark.createDataFrame([("s", "c", [seen("1")])], ATTRIBUTIONS)
    mapping = spark.createDataFrame([(1, "c", 0.5, "q"), (99_500, "c", 0.5, "r")], MAPPING)
    plain = map_discarded(many_of_one_id, attributions, mapping)
    dealt = map_discarded(many_of_one_id, attributions, mapping, hot_rows=10_000, repeated_ids=True)
    found = sorted(map(tuple, dealt.collect()))
    assert found == sorted(map(tuple, plain.collect())) and len(found) == 2

import random

import pytest
from pyspark.sql import functions as F

from tests import plain
from whosaid.functions.quotations import find_quotations, span_pairs, tag_quotation
from whosaid.plans.tagging import tag_articles

WORDS = "articleUID string, content array<string>"


def found(spark, tokens):
    df = spark.createDataFrame([("1", tokens)], WORDS)
    spans = df.select(span_pairs(find_quotations(F.col("content"))).alias("x")).first().x
    return spans and [tuple(s) for s in spans]


def placed(size, **marks):
    """``size`` words with markers at the given positions, e.g. ``s0="``"``."""
    tokens = [f"w{i}" for i in range(size)]
    for key, marker in marks.items():
        tokens[int(key[1:])] = marker
    return tokens


@pytest.mark.parametrize(
    "tokens, expected",
    [
        (placed(9, s0="``", e7="''"), []),
        (placed(9, s0="``", e8="''"), [(0, 8)]),
        (placed(101, s0="``", e99="''"), [(0, 99)]),
        (placed(101, s0="``", e100="''"), []),
        (placed(13, s0="``", s3="``", e12="''"), [(3, 12)]),
        (placed(21, s0="``", e4="''", e20="''"), []),
        (placed(21, e0="''", s5="<q>", e20="</blockquote>"), [(5, 20)]),
        (placed(30, s0="``", e9="''", s10="<q>", e29="</q>"), [(0, 9), (10, 29)]),
        (placed(10), []),
        ([], []),
        (None, None),
    ],
)
def test_find_quotations(spark, tokens, expected):
    assert found(spark, tokens) == expected


def test_tag_quotation(spark):
    tokens = placed(30, s2="``", e10="''", s15="``", e25="''")
    df = spark.createDataFrame([("1", tokens)], WORDS).select(
        "content", find_quotations(F.col("content")).alias("spans")
    )
    row = df.select(
        tag_quotation(F.col("content"), F.col("spans"), F.col("spans")[0]).alias("t")
    ).first().t
    assert row.content == (
        tokens[:2] + ["<INPUT_QUOTATION>"] + tokens[11:15] + ["<QUOTATION>"] + tokens[26:]
    )
    assert row.quotation == tokens[3:10]


@pytest.fixture(scope="module")
def random_articles():
    draw = random.Random(5)
    words = ["a", "b-c", "<p>", "<QUOTATION>", "x-<QUOTATION>", ""] * 6
    words += list(plain.MARKERS)
    return [draw.choices(words, k=draw.randrange(120)) for _ in range(1500)]


def test_tagging_against_the_loop(spark, random_articles):
    df = spark.createDataFrame(
        [(str(i), tokens) for i, tokens in enumerate(random_articles)], WORDS
    )
    expected = []
    for i, tokens in enumerate(random_articles):
        fixed = plain.repair(tokens, bracket_ends=False)
        spans = plain.spans(fixed)
        expected += [(str(i), *plain.tag(fixed, spans, span)) for span in spans]
    rows = [(r.articleUID, r.content, r.quotation) for r in tag_articles(df).collect()]
    assert len(rows) > 1000
    assert sorted(rows) == sorted(expected)


def test_tokens_are_conserved(spark, random_articles):
    df = spark.createDataFrame(
        [(str(i), tokens) for i, tokens in enumerate(random_articles)], WORDS
    )
    for row in tag_articles(df, mode="clean").collect():
        fixed = plain.repair(random_articles[int(row.articleUID)], True, True)
        spans = plain.spans(fixed)
        removed = sum(end - start for start, end in spans)
        assert len(row.content) == len(fixed) - removed
        assert row.content.count("<INPUT_QUOTATION>") == 1

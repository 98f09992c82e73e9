import random

import pytest
from pyspark.sql import functions as F

from tests import plain
from whosaid.functions.tokens import (
    BRACKETS,
    KEPT_TAGS,
    fix_content,
    tokenize,
    tokenize_raw,
    untokenize,
)

TOKENS = "tokens array<string>"


def one(spark, value, schema, column):
    return spark.createDataFrame([(value,)], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "token, expected",
    [
        ("a-b", ["a", "-", "b"]),
        ("a-b-c", ["a", "-", "b"]),
        ("-a", ["", "-", "a"]),
        ("a-", ["a-"]),
        ("--", ["--"]),
        ("-", ["-"]),
        ("a--b", ["a", "-", ""]),
        ("a-\n", ["a", "-", "\n"]),
        ("<p>", []),
        ("<", []),
        ("<q>", ["<q>"]),
        ('<q cite="x">', []),
        ("<Q>", []),
        ("<a-b>", []),
        ("</blockquote>", ["</blockquote>"]),
        ("", [""]),
        ("-LRB-", ["(", "", "-", "LRB"]),
        ("-RSB-", ["]", "", "-", "RSB"]),
    ],
)
def test_fix_content(spark, token, expected):
    assert one(spark, [token], TOKENS, fix_content(F.col("tokens"))) == expected


@pytest.mark.parametrize(
    "token, expected",
    [("-LRB-", ["("]), ("a-b-c", ["a", "-", "b", "-", "c"]), ("a-", ["a-"])],
)
def test_fix_content_clean(spark, token, expected):
    column = fix_content(F.col("tokens"), mode="clean")
    assert one(spark, [token], TOKENS, column) == expected


def test_fix_content_of_null_and_empty(spark):
    assert one(spark, None, TOKENS, fix_content(F.col("tokens"))) is None
    assert one(spark, [], TOKENS, fix_content(F.col("tokens"))) == []
    with pytest.raises(ValueError):
        fix_content(F.col("tokens"), mode="other")


def test_fix_content_against_the_loop(spark):
    draw = random.Random(3)
    words = [*BRACKETS, *KEPT_TAGS, "<p>", "a", "b-c", "-", "--", "-x", "y-"]
    words += ["p-q-r", "", "<", "a--b", "é-ß", "``", "''"]
    lists = [draw.choices(words, k=draw.randrange(12)) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(lists)), f"i int, {TOKENS}")
    rows = df.select(
        "i",
        fix_content(F.col("tokens")).alias("reference"),
        fix_content(F.col("tokens"), "clean").alias("clean"),
    ).collect()
    assert len(rows) == len(lists)
    for row in rows:
        assert row.reference == plain.repair(lists[row.i], bracket_ends=False)
        assert row.clean == plain.repair(lists[row.i], True, every_part=True)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", []),
        ("Hello, world.", ["Hello", ",", "world", "."]),
        ('He said "yes" (and "no").', "He said `` yes '' ( and `` no '' ) .".split()),
        ("“curly” and «guillemets»", "`` curly '' and `` guillemets ''".split()),
        ("I don't; she'll, can’t", "I do n't ; she 'll , ca n't".split()),
        ("'single' l'homme", ["`", "single", "'", "l'homme"]),
        ("wait… now—then", ["wait", "...", "now", "--", "then"]),
        ("$1,000.50 at 10:30", ["$", "1,000.50", "at", "10:30"]),
        ("U.S. Mr. Smith's co-op", ["U.S.", "Mr.", "Smith", "'s", "co-op"]),
        ('<p class="x">"Hi"</p>', ['<p class="x">', "``", "Hi", "''", "</p>"]),
        ("a < b", ["a", "<", "b"]),
        ("x <b and", ["x", "<", "b", "and"]),
        ("&amp;&nbsp;&quot;z&quot;", ["&", "``", "z", "''"]),
        ("see http://x.org/a?b=1, me@x.org", "see http://x.org/a?b=1 , me@x.org".split()),
        ("日本語 😀", ["日本語", "😀"]),
        ("a\xa0b c\x0bd", ["a", "b", "c", "d"]),
    ],
)
def test_tokenize_raw(spark, text, expected):
    assert one(spark, text, "t string", tokenize_raw(F.col("t"))) == expected


def test_tokenize_raw_has_no_depth_limit(spark):
    chain = "-".join(["ab"] * 100_000)
    assert one(spark, chain, "t string", tokenize_raw(F.col("t"))) == [chain]
    dots = "a." * 100_000
    assert one(spark, dots, "t string", tokenize_raw(F.col("t"))) == [dots]


def test_tokenize(spark):
    text = "<p>A well-known -LRB- <q>state-of-the-art</q>"
    tokens = one(spark, text, "t string", tokenize(F.col("t")))
    assert tokens[:4] == ["A", "well", "-", "known"]
    assert tokens[-5:] == ["<q>", "state", "-", "of", "</q>"]


@pytest.mark.parametrize(
    "text",
    [
        'He said "yes" (and "no").',
        "I don't know; she'll see [it].",
        "Prices rose 5%, to $1,000.50!",
    ],
)
def test_untokenize_restores_text(spark, text):
    assert one(spark, text, "t string", untokenize(tokenize_raw(F.col("t")))) == text

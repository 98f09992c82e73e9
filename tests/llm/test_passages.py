"""Operator 13 against all windows of all texts."""

import collections

import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from whosaid.llm.passages import remove_passages, repeated_passages


def brute(texts, window):
    split = [(t or "").encode().split() for t in texts]
    counts = collections.Counter(
        tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1)
    )
    for words in split:
        covered = [False] * len(words)
        for i in range(len(words) - window + 1):
            if counts[tuple(words[i : i + window])] > 1:
                covered[i : i + window] = [True] * window
        kept = b" ".join(w for w, c in zip(words, covered) if not c)
        yield len(words), sum(covered), kept


def found(df, window, **options):
    rows = remove_passages(df, window=window, **options).collect()
    for r in rows:
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    return collections.Counter(
        (r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in rows
    )


@pytest.mark.parametrize(
    "seed, window, options",
    [
        (1, 7, {}),
        # Many segments and buckets, and keys that are hot in two segments.
        (2, 6, {"segment_bytes": 3000, "bucket_bytes": 5000, "hot_segments": 2}),
        # Nearly all keys collide: words decide.
        (3, 7, {"segment_bytes": 3000, "bucket_bytes": 9000, "key_bits": 1}),
        (4, 2, {"segment_bytes": 9000}),
        (5, 12, {"segment_bytes": 3000, "hot_segments": 1, "key_bits": 9}),
    ],
)
def test_against_all_windows(spark, seed, window, options):
    df = plain.frame(spark, plain.odd_texts(seed))
    rows = df.select("doc_id", "text").collect()
    want = brute([r.text for r in rows], window)
    assert found(df, window, **options) == collections.Counter(
        (r.doc_id, *w) for r, w in zip(rows, want)
    )


def test_a_text_that_repeats_itself(spark):
    period = " ".join(f"p{i}" for i in range(9))
    texts = ["a " * 50, period + " " + period + " x " + period, "a\ta\x0ba\x0ca a\r\na a a"]
    df = plain.frame(spark, texts, False)
    want = collections.Counter((i, *w) for i, w in enumerate(brute(texts, 5)))
    assert found(df, 5) == want


def test_copies_of_one_text_are_dealt(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    got = found(df, 35)
    assert len(got) == 3000 and {g[1:] for g in got} == {(40, 40, b"")}
    plan = repeated_passages(df)._jdf.queryExecution().toString()
    assert "doc_id" not in plan.split("== Optimized Logical Plan ==")[1]


def test_an_empty_table(spark):
    assert remove_passages(plain.empty(spark)).collect() == []
    with pytest.raises(ValueError):
        remove_passages(plain.empty(spark), window=65)

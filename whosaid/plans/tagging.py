"""Find every quotation of a corpus and make one training row of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from whosaid.functions.quotations import (
    MAX_LENGTH,
    MIN_LENGTH,
    own_tag,
    tag_template,
)
from whosaid.functions.tokens import fix_content
from whosaid.operators.articles import project_articles, sample_rows


def tag_articles(
    articles: DataFrame,
    mode: str = "reference",
    min_len: int = MIN_LENGTH,
    max_len: int = MAX_LENGTH,
) -> DataFrame:
    """Articles ``(articleUID, content)`` to ``(articleUID, content, quotation)``.

    No shuffle. What an article's rows share is computed once per article, as
    one expression; each row then differs from it in one token.
    """
    tokens = fix_content(F.col("content"), mode)
    shared = articles.select(
        "articleUID", tag_template(tokens, min_len, max_len).alias("shared")
    )
    # A field, not a column, goes into the generator: Spark would add a filter on
    # a column's size below, and so compute all of it a second time.
    rows = shared.select(
        "articleUID", F.col("shared.base").alias("base"), F.inline("shared.items")
    )
    return rows.select(
        "articleUID",
        own_tag(F.col("base"), F.col("at")).alias("content"),
        "quotation",
    )


def tag_corpus(
    entries: DataFrame,
    fraction: float | None = None,
    seed: int = 0,
    mode: str = "reference",
    sample_key: Column | None = None,
) -> DataFrame:
    """Every quotation of every entry, or of a sample of the entries.

    The sample is drawn by key, that of the feed entry if none is given.
    """
    if fraction is not None:
        key = F.col("feedEntry.identifier") if sample_key is None else sample_key
        entries = sample_rows(entries, fraction, seed, key)
    return tag_articles(project_articles(entries), mode)

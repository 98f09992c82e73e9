"""Attach article content to (quotation, speaker) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from whosaid.functions.tokens import fix_content, tokenize
from whosaid.operators.articles import explode_occurrences, project_articles
from whosaid.operators.joins import join_articles


def extract_articles(
    entries: DataFrame,
    attributions: DataFrame,
    mode: str = "reference",
    hot_rows: int | None = None,
    repeated_ids: bool = False,
) -> DataFrame:
    """One row per occurrence of a quotation in an article of the corpus.

    Articles move once, to the ids of the occurrences; those without one go, and
    each of the others is repaired once. The rows of hot articles are spread
    over tasks. ``repeated_ids`` spreads the articles of an id that has very many,
    too; it reads the ids once more.
    """

    def repair(articles: DataFrame) -> DataFrame:
        return articles.withColumn("content", fix_content(F.col("content"), mode))

    joined = join_articles(
        project_articles(entries),
        explode_occurrences(attributions),
        hot_rows,
        repair,
        repeated_ids,
    )
    return joined.select(
        "articleUID",
        "extractedBy",
        "patternConfidence",
        "speaker",
        "content",
        tokenize(F.col("quotation"), mode).alias("quotation"),
    )

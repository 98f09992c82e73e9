"""Give discarded pairs the speaker of the quotation that stands for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from whosaid.functions.tokens import fix_content, tokenize
from whosaid.operators.articles import project_articles
from whosaid.operators.dedupe import dedupe_pairs, one_per_article
from whosaid.operators.joins import join_mapping, join_speakers
from whosaid.sources.sinks import stage


def distinct_speakers(attributions: DataFrame) -> DataFrame:
    """``(canonicalQuotation, speaker)`` of quotations that were seen, once each."""
    # The size of one field, so that no other is read.
    seen = attributions.where(F.size(F.col("occurrences.articleUID")) > 0)
    return seen.select("canonicalQuotation", "speaker").distinct()


def mapped_pairs(
    attributions: DataFrame, mapping: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """``(articleUID, speaker, quotation, confidence)``, without content.

    How often a quotation was seen does not matter here, so each (quotation,
    speaker) joins once.
    """
    links = mapping.where(F.col("articleUID").isNotNull())
    joined = join_speakers(distinct_speakers(attributions), links, hot_rows)
    return dedupe_pairs(
        joined.select(
            "articleUID",
            "speaker",
            F.col("canonicalQuotationSource").alias("quotation"),
            "confidence",
        )
    )


def map_discarded(
    entries: DataFrame,
    attributions: DataFrame,
    mapping: DataFrame,
    mode: str = "reference",
    hot_rows: int | None = None,
    repeated_ids: bool = False,
) -> DataFrame:
    """One row per (article, speaker, quotation), with the article's content.

    The narrow tables are joined, deduplicated and stored first, since their
    rows are counted and then joined: that is the one job of building the plan.
    Articles move once, to the ids of the pairs; of an id's articles one stays,
    and it is repaired once. ``repeated_ids`` spreads the articles of an id that
    has very many; it reads the ids once more.
    """
    pairs = stage(mapped_pairs(attributions, mapping, hot_rows))

    def one_repaired(articles: DataFrame) -> DataFrame:
        one = one_per_article(articles, ["_parts", "_left"])
        return one.withColumn("_given", F.col("content")).withColumn(
            "content", fix_content(F.col("content"), mode)
        )

    def one_of_parts(articles: DataFrame) -> DataFrame:
        first = F.min(F.struct("_given", "content")).alias("_one")
        one = articles.groupBy("articleUID", "_parts").agg(first)
        return one.select("articleUID", "_parts", "_one.*")

    joined = join_mapping(
        project_articles(entries),
        pairs,
        hot_rows,
        one_repaired,
        repeated_ids,
        one_of_parts if repeated_ids else None,
    )
    return joined.select(
        "articleUID",
        "confidence",
        "speaker",
        "content",
        tokenize(F.col("quotation"), mode).alias("quotation"),
    )

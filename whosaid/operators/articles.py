"""Row-wise operators on entries and articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_articles(entries: DataFrame) -> DataFrame:
    """``(articleUID, content)``: the feed entry's id, the permalink's tokens."""
    return entries.select(
        F.col("feedEntry.identifier").alias("articleUID"),
        F.col("permalinkEntry.tokenizedContent").alias("content"),
    )


def cast_id(identifier: Column) -> Column:
    """A text id as a number; text that is no number gives null."""
    return identifier.try_cast("bigint")


def filter_publisher(entries: DataFrame, types: Sequence[str]) -> DataFrame:
    """Entries whose publisher type is listed; an empty list keeps all.

    A record without a type has the empty one, before normalizing and after.
    """
    if not types:
        return entries
    given = F.col("source.publisherType")
    listed = given.isin(*types)
    return entries.where(listed | given.isNull() if "" in types else listed)


def sample_rows(df: DataFrame, fraction: float, seed: int, key: Column) -> DataFrame:
    """Each key with probability ``fraction``; all rows from 1 up.

    A hash of the key and the seed decides, so that the sample stays the same
    however the rows are partitioned or recomputed. Rows with one key stay or go
    together; a null counts as empty text.
    """
    if fraction >= 1:
        return df
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("bigint")
    return df.where(draw < int(fraction * 2**32))


#: A part has no more rows than this, so that one task can take it.
PART_ROWS = 10_000


def repartition_rows(df: DataFrame, partitions: int) -> DataFrame:
    """The same rows in ``partitions`` even parts, or in more where these would have
    more than ``PART_ROWS`` rows; 0 changes nothing.

    A job counts the rows first. It reads no columns but those that decide which
    rows there are.
    """
    if partitions <= 0:
        return df
    return df.repartition(max(partitions, -(-df.count() // PART_ROWS)))


def explode_occurrences(
    attributions: DataFrame, keep_canonical: bool = False
) -> DataFrame:
    """One row per place a quotation was seen."""
    kept = ["canonicalQuotation"] if keep_canonical else []
    rows = attributions.select("speaker", *kept, F.inline("occurrences"))
    return rows.select(
        *kept, "articleUID", "quotation", "extractedBy", "patternConfidence", "speaker"
    )


def occurrence_ids(attributions: DataFrame) -> DataFrame:
    """The article ids of `explode_occurrences`, reading nothing but them."""
    return attributions.select(
        F.explode(F.col("occurrences.articleUID")).alias("articleUID")
    )


def explode_quotations(articles: DataFrame) -> DataFrame:
    """One row per span in ``quotationIndexes``, as ``quotationIndex``.

    The outer form with its own filter: for a plain explode Spark adds a filter
    on the list's size below, and so computes the list twice.
    """
    rows = articles.select(
        "*", F.explode_outer("quotationIndexes").alias("quotationIndex")
    )
    return rows.where(F.col("quotationIndex").isNotNull())

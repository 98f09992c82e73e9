"""Duplicate removal. Each choice among duplicates is a fixed one."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from whosaid.operators.articles import cast_id
from whosaid.operators.joins import join_mapping
from whosaid.sources.sinks import stage


def dedupe_pairs(df: DataFrame, articles: DataFrame | None = None) -> DataFrame:
    """One row per (articleUID, speaker, quotation), with its top confidence.

    A content column, if there is one, gives its smallest value. Nulls form a
    group. Rows are combined before the shuffle.

    Contents that depend on the article only are better given apart, as
    ``articles`` (articleUID, content): the pairs are chosen and stored without
    them, and the smallest content of an article, whose text id is cast, joins
    those that remain. Pairs without an article go.
    """
    values = [F.max("confidence").alias("confidence")]
    if articles is None and "content" in df.columns:
        values.append(F.min("content").alias("content"))
    pairs = df.groupBy("articleUID", "speaker", "quotation").agg(*values)
    if articles is None:
        return pairs
    return join_mapping(
        articles, stage(pairs), prepare=lambda a: one_per_article(a, ["_parts", "_left"])
    ).select("articleUID", "speaker", "quotation", "confidence", "content")


def one_per_article(articles: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """One content per article id: the smallest. ``also`` are further columns of
    the key."""
    return articles.groupBy("articleUID", *also).agg(F.min("content").alias("content"))


def dedupe_content(
    entries: DataFrame,
    content: str = "permalinkEntry.tokenizedContent",
    identifier: str = "permalinkEntry.identifier",
    keep_empty: bool = False,
) -> DataFrame:
    """One entry per distinct content: that with the lowest numeric id.

    All entries without content, null or empty, count as copies of each other;
    ``keep_empty`` keeps them all. The entries are stored first, see
    ``first_per_key``.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in entries.columns])
    ranked = entries.select(
        row.alias("_row"),
        content_key(F.col(content)).alias("_key"),
        content_rank(F.col(identifier), row).alias("_rank"),
    )
    return first_per_key(ranked, F.col("_key"), keep_empty).select("_row.*")


def content_key(tokens: Column) -> Column:
    """A SHA-256 of a token list; null for one that is empty or null."""
    spelled = F.to_json(F.struct(tokens.alias("c")))
    return F.when(F.size(tokens) > 0, F.unhex(F.sha2(spelled, 256)))


def content_rank(identifier: Column, row: Column) -> Column:
    """The order of entries with one content, as a number of fixed width: by their
    numeric id, those whose id is no number last, then by a hash of the row."""
    number = cast_id(identifier).cast("decimal(20,0)") + F.lit(Decimal(1 << 63))
    last = F.lit(Decimal(1 << 64))
    tie = F.pmod(F.xxhash64(row), F.lit(_TIES))
    scaled = F.coalesce(number, last).cast("decimal(20,0)") * F.lit(Decimal(_TIES))
    return (scaled + tie).cast("decimal(38,0)")


_TIES = 10**18


def first_per_key(ranked: DataFrame, key: Column, keep_empty: bool = False) -> DataFrame:
    """The rows that have the lowest ``_rank`` of their key, one per key.

    The null key, that of empty contents, is one like the others, or keeps all of
    its rows. The rows are stored, once and as they are, each with a number. Only
    key, rank and number go through the aggregation, in buffers of fixed width
    that are combined before the shuffle, so that a key with countless rows sends
    one per task. The numbers that it gives then pick the stored rows, by a hash
    table: nothing wide is sorted or held.
    """
    stored = stage(ranked.withColumn("_number", F.monotonically_increasing_id()))
    group = [key]
    if keep_empty:
        group.append(F.when(key.isNull(), F.col("_number")))
    first = stored.groupBy(*group).agg(F.min_by("_number", "_rank").alias("_number"))
    chosen = first.select("_number").hint("shuffle_hash")
    return stored.join(chosen, "_number", "left_semi").drop("_number", "_rank")

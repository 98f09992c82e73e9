"""Decoded feed records to clean, tokenized, distinct entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from whosaid.functions.binding import bind
from whosaid.operators.articles import (
    filter_publisher,
    repartition_rows,
    sample_rows,
)
from whosaid.operators.dedupe import content_key, content_rank, first_per_key
from whosaid.operators.entries import body_content, entry_columns, normalize_entries
from whosaid.sources.archives import decode_records, scan_archives

def ingest_entries(
    raw: DataFrame,
    types: Sequence[str] = (),
    fraction: float = 1.0,
    seed: int = 0,
    sample_key: Column | None = None,
    partitions: int = 0,
    dedupe: bool = False,
    clean: bool = True,
    tokenize: bool = True,
    keep_empty: bool = False,
    on_error: str = "fail",
) -> DataFrame:
    """Records of schema RAW to entries of schema ENTRY.

    Filter and sample come before the costly steps, which gives the same rows.
    The sample is drawn by key, that of the feed entry if none is given.
    Duplicates are removed after the sample, as their order matters. The permalink's
    tokens are made once, for all records, and stored with the records as they
    came; the feed entry's body is made for those that stay.
    """
    key = F.col("feedEntry.identifier") if sample_key is None else sample_key
    wanted = sample_rows(filter_publisher(raw, types), fraction, seed, key)
    how = clean, tokenize, on_error
    if dedupe:
        contents = {"feedEntry": body_content("feedEntry", *how), "permalinkEntry": F.col("_made.tokens")}
        made = entry_columns(contents)
        once = _distinct(wanted, body_content("permalinkEntry", *how), keep_empty)
        entries = once.select(*[column.alias(name) for name, column in made.items()])
    else:
        entries = normalize_entries(wanted, *how)
    return repartition_rows(entries, partitions)


def _distinct(raw: DataFrame, tokens: Column, keep_empty: bool) -> DataFrame:
    """The records to keep, each with its permalink's tokens as ``_made.tokens``
    instead of the payload."""

    def both(tokens: Column) -> Column:
        return F.struct(tokens.alias("tokens"), content_key(tokens).alias("key"))

    row = F.struct(*[F.col(c) for c in ("source", "feed", "feedEntry", "permalinkEntry")])
    ranked = raw.select(
        "source",
        "feed",
        "feedEntry",
        F.col("permalinkEntry").dropFields("contentExtract").alias("permalinkEntry"),
        bind(tokens, both).alias("_made"),
        content_rank(F.col("permalinkEntry.identifier"), row).alias("_rank"),
    )
    return first_per_key(ranked, F.col("_made.key"), keep_empty)


def ingest_archives(
    spark: SparkSession,
    glob: str,
    stream: bool = True,
    spread: int = 0,
    **options,
) -> DataFrame:
    """`ingest_entries` on the JSON lines in tar.gz archives.

    ``spread`` gives the lines of few, large archives that many tasks; without
    ``stream`` Spark reads each archive whole.
    """
    members = scan_archives(spark, glob, stream=stream, lines=True)
    return ingest_entries(decode_records(members, spread), **options)

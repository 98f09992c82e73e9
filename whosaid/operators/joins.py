"""The three joins of the quotation jobs. All are inner; null never matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from whosaid.operators.articles import cast_id
from whosaid.operators.skew import spread_join

Prepare = Callable[[DataFrame], DataFrame]


def join_articles(
    articles: DataFrame,
    occurrences: DataFrame,
    hot_rows: int | None = None,
    prepare: Prepare | None = None,
    repeated_ids: bool = False,
) -> DataFrame:
    """Articles with the occurrences found in them, by text id.

    A hot article's occurrences are spread over tasks; ``prepare`` is done once
    to each article that has any. ``repeated_ids`` counts the articles by id and
    spreads those of a hot id too.
    """
    return spread_join(
        articles, occurrences, "articleUID", "articleUID", hot_rows,
        prepare=prepare, deal_left=repeated_ids,
    )


def join_mapping(
    articles: DataFrame,
    mapping: DataFrame,
    hot_rows: int | None = None,
    prepare: Prepare | None = None,
    repeated_ids: bool = False,
    combine: Prepare | None = None,
) -> DataFrame:
    """Articles with the mapping rows that name them, by numeric id.

    The article's text id is cast; the mapping's id is kept. ``repeated_ids`` is
    as in ``join_articles``; ``combine`` does over the parts of a hot id what
    ``prepare`` did to each.
    """
    by_number = articles.select(
        cast_id(F.col("articleUID")).alias("articleUID"),
        *[c for c in articles.columns if c != "articleUID"],
    )
    return spread_join(
        by_number, mapping, "articleUID", "articleUID", hot_rows,
        prepare=prepare, deal_left=repeated_ids, combine=combine,
    )


def join_speakers(
    quotations: DataFrame, links: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """Quotations that have a speaker, with the links that lead to them.

    The canonical quotation must equal the link's destination exactly. Either
    side may be hot.
    """
    return spread_join(
        quotations,
        links,
        "canonicalQuotation",
        "canonicalQuotationDestination",
        hot_rows,
        left_is_hot=True,
    )

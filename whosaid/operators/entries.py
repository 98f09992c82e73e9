"""Decoded feed records to entries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from whosaid.functions.binding import bind
from whosaid.functions.html import clean_html
from whosaid.functions.payload import inflate_content
from whosaid.functions.tokens import tokenize_raw


def _text(path: str) -> Column:
    """A field that is empty text where the record has none."""
    return F.coalesce(F.col(path), F.lit(""))


def _first(path: str, field: str) -> Column:
    return F.coalesce(F.get(F.col(path), F.lit(0))[field], F.lit(""))


def _content(
    payload: str, url: Column, clean: bool, tokenize: bool, on_error: str
) -> Column:
    """A payload's tokens, or its whole text as one; none without a payload."""
    data, encoding = F.col(f"{payload}.data"), F.col(f"{payload}.encoding")
    text = inflate_content(data, encoding, on_error)

    def tokens(text: Column) -> Column:
        listed = tokenize_raw(text) if tokenize else F.array(text)
        return F.when(text.isNotNull(), listed)

    # The cleaned text is long to make; it is bound, and so made once.
    made = bind(clean_html(text, url) if clean else text, tokens)
    there = F.when(F.col(payload).isNotNull(), made)
    return F.coalesce(there, F.array().cast("array<string>"))


def _body(record: str, content: Column) -> Column:
    return F.struct(
        F.coalesce(F.col(f"{record}.identifier"), F.lit(0))
        .cast("string")
        .alias("identifier"),
        _text(f"{record}.canonicalLink.href").alias("url"),
        _text(f"{record}.title").alias("title"),
        _first(f"{record}.lang", "code").alias("language"),
        _first(f"{record}.author", "name").alias("authorName"),
        _first(f"{record}.author", "email").alias("authorEmail"),
        _text(f"{record}.lastPublished").alias("lastPublished"),
        _text(f"{record}.dateFound").alias("dateFound"),
        content.alias("tokenizedContent"),
    )


#: The payload of each of a record's two bodies.
PAYLOADS = {"feedEntry": "content", "permalinkEntry": "contentExtract"}


def body_content(
    record: str, clean: bool = True, tokenize: bool = True, on_error: str = "fail"
) -> Column:
    """The tokens of a record's body, from its payload."""
    url = _text(f"{record}.canonicalLink.href")
    return _content(f"{record}.{PAYLOADS[record]}", url, clean, tokenize, on_error)


def entry_columns(contents: Mapping[str, Column]) -> dict[str, Column]:
    """The columns of schema ENTRY from a record and the tokens of bodies."""
    source = F.struct(
        _text("source.canonicalLink.href").alias("url"),
        _text("source.title").alias("title"),
        _first("source.lang", "code").alias("language"),
        _text("source.description").alias("description"),
        _text("source.lastPosted").alias("lastPosted"),
        _text("source.lastPublished").alias("lastPublished"),
        _text("source.dateFound").alias("dateFound"),
        _text("source.publisherType").alias("publisherType"),
    )
    feed = F.struct(
        _text("feed.canonicalLink.href").alias("url"),
        _text("feed.title").alias("title"),
        _first("feed.lang", "code").alias("language"),
        _text("feed.lastPosted").alias("lastPosted"),
        _text("feed.lastPublished").alias("lastPublished"),
        _text("feed.dateFound").alias("dateFound"),
        _text("feed.channelLink.href").alias("channelUrl"),
    )
    bodies = {record: _body(record, content) for record, content in contents.items()}
    return {"source": source, "feed": feed} | bodies


def normalize_entries(
    raw: DataFrame, clean: bool = True, tokenize: bool = True, on_error: str = "fail"
) -> DataFrame:
    """Records of schema RAW as entries of schema ENTRY.

    Absent text becomes empty, the first language and author count, and absent
    content becomes no tokens. So does a corrupt payload with
    ``on_error="null"``; otherwise it fails the job.
    """
    contents = {r: body_content(r, clean, tokenize, on_error) for r in PAYLOADS}
    made = entry_columns(contents)
    return raw.select(*[column.alias(name) for name, column in made.items()])

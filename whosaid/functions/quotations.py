"""Find quotations in tokens and replace them by tags.

A span is ``struct<start, end>``: the positions of its two markers, counted
from 0, both inclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from whosaid.functions.binding import bind

# The markers, the two tags, and the length limits.
START_MARKERS = ("``", "<q>", "<blockquote>")
END_MARKERS = ("''", "</q>", "</blockquote>")
OWN_TAG = "<INPUT_QUOTATION>"
OTHER_TAG = "<QUOTATION>"
MIN_LENGTH = 8
MAX_LENGTH = 100


def find_quotations(
    tokens: Column, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH
) -> Column:
    """Spans with ``min_len <= end - start < max_len``, as an array.

    The kinds of the two markers need not match, a new start moves the start,
    and an end that fails the length test still closes. So a span is exactly a
    start marker whose next marker is an end, and two neighbours in the list of
    markers decide it. A marker is one number: twice its position, plus one for
    an end.
    """

    def mark(token: Column, i: Column) -> Column:
        return F.when(token.isin(*START_MARKERS), i * 2).when(
            token.isin(*END_MARKERS), i * 2 + 1
        )

    def spans(marks: Column) -> Column:
        def span(m: Column, j: Column) -> Column:
            before = F.get(marks, j - 1)
            start, end = F.shiftright(before, 1), F.shiftright(m, 1)
            length = end - start
            is_pair = (m % 2 == 1) & (before % 2 == 0)
            fits = (length >= min_len) & (length < max_len)
            return F.when(
                is_pair & fits, F.struct(start.alias("start"), end.alias("end"))
            )

        return F.filter(F.transform(marks, span), lambda s: s.isNotNull())

    marks = F.filter(F.transform(tokens, mark), lambda m: m.isNotNull())
    return bind(marks, spans)


def span_pairs(spans: Column) -> Column:
    """Spans as ``array<array<int>>``."""
    return F.transform(spans, lambda s: F.array(s["start"], s["end"]))


def _replace_spans(tokens: Column, spans: Column, tag) -> Column:
    """Tokens with each span, markers included, replaced by ``tag(span)``."""

    def text_then_tag(span: Column, k: Column) -> Column:
        after = F.coalesce(F.get(spans, k - 1)["end"], F.lit(-1)) + 1
        before = F.slice(tokens, after + 1, span["start"] - after)
        return F.concat(before, F.array(tag(span)))

    tail_from = F.coalesce(F.get(spans, F.size(spans) - 1)["end"], F.lit(-1)) + 1
    tail = F.slice(tokens, tail_from + 1, F.size(tokens) - tail_from)
    pieces = F.concat(F.transform(spans, text_then_tag), F.array(tail))
    return F.flatten(pieces)


def _inner(tokens: Column, span: Column) -> Column:
    return F.slice(tokens, span["start"] + 2, span["end"] - span["start"] - 1)


def tag_quotation(tokens: Column, spans: Column, span: Column) -> Column:
    """``struct<content, quotation>`` for one of the spans.

    The content has a tag in place of each quotation, with its own tag for
    ``span``; the quotation is the text between that span's markers.
    """

    def tag(s: Column) -> Column:
        own = (s["start"] == span["start"]) & (s["end"] == span["end"])
        return F.when(own, OWN_TAG).otherwise(OTHER_TAG)

    return F.struct(
        _replace_spans(tokens, spans, tag).alias("content"),
        _inner(tokens, span).alias("quotation"),
    )


def tag_template(tokens: Column, min_len: int, max_len: int) -> Column:
    """What all tagged rows of one article share, computed once per article.

    ``struct<base, items>``: ``base`` has the common tag for every span;
    ``items`` has for each span the position ``at`` of its tag in ``base`` and
    its ``quotation``. `own_tag` then makes a row's content.
    """

    def build(c: Column) -> Column:
        def with_spans(spans: Column) -> Column:
            def item(span: Column, k: Column) -> Column:
                removed = F.aggregate(
                    F.slice(spans, F.lit(1), k),
                    F.lit(0),
                    lambda n, s: n + s["end"] - s["start"],
                )
                return F.struct(
                    (span["start"] - removed).alias("at"),
                    _inner(c, span).alias("quotation"),
                )

            base = _replace_spans(c, spans, lambda s: F.lit(OTHER_TAG))
            # Most articles quote nothing; they need no copy of their text.
            base = F.when(F.size(spans) > 0, base)
            return F.struct(
                base.alias("base"), F.transform(spans, item).alias("items")
            )

        return bind(find_quotations(c, min_len, max_len), with_spans)

    return bind(tokens, build)


def own_tag(base: Column, at: Column) -> Column:
    """``base`` with the tag at position ``at`` marked as the row's own."""
    return F.concat(
        F.slice(base, F.lit(1), at),
        F.array(F.lit(OWN_TAG)),
        F.slice(base, at + 2, F.size(base)),
    )

"""Declared schemas, as DDL, so that no JSON read needs an inference pass."""

from __future__ import annotations

_BODY = (
    "identifier string, url string, title string, language string, "
    "authorName string, authorEmail string, lastPublished string, "
    "dateFound string, tokenizedContent array<string>"
)

#: One ingested article, as the ingest job writes it.
ENTRY = (
    "source struct<url string, title string, language string, "
    "description string, lastPosted string, lastPublished string, "
    "dateFound string, publisherType string>, "
    "feed struct<url string, title string, language string, "
    "lastPosted string, lastPublished string, dateFound string, "
    "channelUrl string>, "
    f"feedEntry struct<{_BODY}>, "
    f"permalinkEntry struct<{_BODY}>"
)

#: The part of ENTRY that the quotation jobs need. Reading JSON with it makes
#: the parser skip every other field.
ARTICLE = (
    "feedEntry struct<identifier string>, "
    "permalinkEntry struct<tokenizedContent array<string>>"
)

#: Quotations with their speaker and every place they were seen.
ATTRIBUTIONS = (
    "speaker string, canonicalQuotation string, "
    "occurrences array<struct<articleUID string, quotation string, "
    "extractedBy string, patternConfidence double>>"
)

#: Pairs without a speaker, linked to a quotation that has one.
MAPPING = (
    "articleUID bigint, canonicalQuotationDestination string, "
    "confidence double, canonicalQuotationSource string"
)

#: The same two as they are written: numbers bare or quoted.
ATTRIBUTIONS_TEXT = ATTRIBUTIONS.replace("patternConfidence double", "patternConfidence string")
MAPPING_TEXT = MAPPING.replace("bigint", "string").replace("double", "string")

_LINK = "struct<href string>"
_LANG = "array<struct<code string>>"
_AUTHOR = "array<struct<name string, email string>>"
_PAYLOAD = "struct<encoding string, data binary>"

#: A decoded feed record, before cleaning and tokenizing. As JSON, ``data`` is
#: base64 text, which Spark reads into a binary column.
RAW = (
    f"source struct<canonicalLink {_LINK}, title string, lang {_LANG}, "
    "description string, lastPosted string, lastPublished string, "
    "dateFound string, publisherType string>, "
    f"feed struct<canonicalLink {_LINK}, title string, lang {_LANG}, "
    "lastPosted string, lastPublished string, dateFound string, "
    f"channelLink {_LINK}>, "
    f"feedEntry struct<identifier bigint, canonicalLink {_LINK}, title string, "
    f"lang {_LANG}, author {_AUTHOR}, lastPublished string, "
    f"dateFound string, content {_PAYLOAD}>, "
    f"permalinkEntry struct<identifier bigint, canonicalLink {_LINK}, "
    f"title string, lang {_LANG}, author {_AUTHOR}, lastPublished string, "
    f"dateFound string, contentExtract {_PAYLOAD}>"
)

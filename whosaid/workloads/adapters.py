"""The test tables in the shape of the library's inputs.

`oracles` states the same derivations in SQL.
"""

from __future__ import annotations

import io
import re
import sys
import tarfile
import zlib
from collections.abc import Iterator
from itertools import chain, count, islice

from pyarrow.fs import FileSystem
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StructType

from whosaid.schemas import RAW
from whosaid.sources.sinks import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A test table can be one row group, which is one busy task of all its splits.
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.repartition(spark.sparkContext.defaultParallelism)


def quoted_tokens(text: Column) -> Column:
    """Words, where one with a comma opens and one with a stop closes a quote."""

    def mark(t: Column) -> Column:
        return F.when(t.endswith(","), "``").when(t.endswith("."), "''").otherwise(t)

    return F.transform(F.split(text, " "), mark)


def odd_tokens(text: Column) -> Column:
    """The same with dashes, bracket escapes and tags at fixed steps."""
    return F.transform(
        quoted_tokens(text),
        lambda t, i: F.when(i % 101 == 0, "-LRB-")
        .when(i % 103 == 0, "<p>")
        .when(i % 107 == 0, "<q>")
        .when(i % 109 == 0, "</q>")
        .when(i % 17 == 0, F.concat(t, F.lit("-"), t))
        .when(i % 19 == 0, F.concat(t, F.lit("-x-y")))
        .when(i % 23 == 0, F.concat(t, F.lit("--")))
        .otherwise(t),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("articleUID"),
        quoted_tokens(F.col("text")).alias("content"),
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema ENTRY; the feed entry holds the text as one token."""
    none = F.lit("")
    link = F.concat(F.lit("http://news.example/"), F.col("doc_id"))

    def body(identifier: Column, content: Column) -> Column:
        return F.struct(
            identifier.cast("string").alias("identifier"),
            link.alias("url"),
            none.alias("title"),
            F.col("lang").alias("language"),
            none.alias("authorName"),
            none.alias("authorEmail"),
            none.alias("lastPublished"),
            none.alias("dateFound"),
            content.alias("tokenizedContent"),
        )

    source = F.struct(
        link.alias("url"),
        none.alias("title"),
        F.col("lang").alias("language"),
        none.alias("description"),
        none.alias("lastPosted"),
        none.alias("lastPublished"),
        none.alias("dateFound"),
        F.col("source").alias("publisherType"),
    )
    feed = F.struct(
        link.alias("url"),
        none.alias("title"),
        F.col("lang").alias("language"),
        none.alias("lastPosted"),
        none.alias("lastPublished"),
        none.alias("dateFound"),
        none.alias("channelUrl"),
    )
    return table(spark, sf_dir, "documents").select(
        source.alias("source"),
        feed.alias("feed"),
        body(F.col("doc_id"), F.array("text")).alias("feedEntry"),
        body(F.col("doc_id") * 2 + 1, quoted_tokens(F.col("text"))).alias(
            "permalinkEntry"
        ),
    )


def attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per turn, with two occurrences; none for the system's turns."""
    first = F.struct(
        (F.col("conv_id") * 7 + F.col("turn")).cast("string").alias("articleUID"),
        F.col("text").alias("quotation"),
        F.col("role").alias("extractedBy"),
        ((F.col("turn") + 1) / F.lit(10.0)).alias("patternConfidence"),
    )
    second = F.struct(
        F.when(F.col("turn") == 0, F.concat(F.lit("unknown-"), F.col("conv_id")))
        .otherwise((F.col("conv_id") * 3 + F.col("turn")).cast("string"))
        .alias("articleUID"),
        F.col("text").alias("quotation"),
        F.lit("repeat").alias("extractedBy"),
        ((F.col("turn") + 1) / F.lit(20.0)).alias("patternConfidence"),
    )
    seen = F.array(first, second)
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("_", "role", "conv_id").alias("speaker"),
        F.concat(F.lit("conversation "), F.col("conv_id")).alias("canonicalQuotation"),
        F.when(F.col("role") == "system", F.slice(seen, 1, 0))
        .otherwise(seen)
        .alias("occurrences"),
    )


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 13 + F.floor(F.col("turn") / 4)).alias("articleUID"),
        F.concat(F.lit("conversation "), F.col("conv_id")).alias(
            "canonicalQuotationDestination"
        ),
        ((F.col("turn") + 1) / F.lit(10.0)).alias("confidence"),
        F.col("text").alias("canonicalQuotationSource"),
    )


# A plain function, which gets few texts at a time.
@F.udf(BinaryType(), useArrow=False)
def deflate(text: str) -> bytes:
    return zlib.compress(text.encode("utf-8"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema RAW, with every kind of absent field.

    Spanish records have no language and no content extract, German ones no
    author, and a German extract has an encoding that is not read.
    """
    url = F.concat(F.lit("http://news.example/"), F.col("doc_id"))
    link = F.struct(url.alias("href"))
    no_text = F.lit(None).cast("string")
    lang = F.array(F.struct(F.col("lang").alias("code")))
    lang = F.when(F.col("lang") == "es", F.slice(lang, 1, 0)).otherwise(lang)
    author = F.array(
        F.struct(
            F.col("source").alias("name"),
            F.concat("source", F.lit("@news.example")).alias("email"),
        )
    )
    author = F.when(F.col("lang") != "de", author)
    data = deflate(F.col("text"))
    content = F.struct(F.lit("zlib").alias("encoding"), data.alias("data"))
    extract = F.struct(
        F.when(F.col("lang") == "de", "identity").otherwise("zlib").alias("encoding"),
        data.alias("data"),
    )

    def body(identifier: Column, name: str, payload: Column) -> Column:
        return F.struct(
            identifier.alias("identifier"),
            link.alias("canonicalLink"),
            no_text.alias("title"),
            lang.alias("lang"),
            author.alias("author"),
            no_text.alias("lastPublished"),
            no_text.alias("dateFound"),
            payload.alias(name),
        )

    source = F.struct(
        link.alias("canonicalLink"),
        F.col("source").alias("title"),
        lang.alias("lang"),
        no_text.alias("description"),
        no_text.alias("lastPosted"),
        no_text.alias("lastPublished"),
        no_text.alias("dateFound"),
        F.col("source").alias("publisherType"),
    )
    feed = F.struct(
        link.alias("canonicalLink"),
        no_text.alias("title"),
        lang.alias("lang"),
        no_text.alias("lastPosted"),
        no_text.alias("lastPublished"),
        no_text.alias("dateFound"),
        link.alias("channelLink"),
    )
    return table(spark, sf_dir, "documents").select(
        source.alias("source"),
        feed.alias("feed"),
        body(F.col("doc_id"), "content", content).alias("feedEntry"),
        body(
            F.col("doc_id") * 2 + 1,
            "contentExtract",
            F.when(F.col("lang") != "es", extract),
        ).alias("permalinkEntry"),
    )


def quote_tags(html: Column) -> Column:
    """Bold text as quotations, so that pages have some."""
    return F.regexp_replace(F.regexp_replace(html, "<b>", "<q>"), "<br>", "</q>")


#: Markup that is added to the pages in turn: entities and links of all kinds,
#: elements that are never closed or cross each other, and quoted brackets.
ODD_MARKUP = (
    '<p>caf&eacute; it&#x27;s &#233;t&#233; &copy 2 &nosuch; 1 < 2 '
    '<a href="../up?x=1#y" title="a &quot;b&quot;" onclick="z()">up</a>'
    '<q cite="/c">said</q>',
    "a<!-- open <b>comment",
    "x<script>open code <p>",
    "<a href=javascript:x()>j</a><a HREF='mailto:a@b.c' rel=nofollow>m</a>"
    '<blockquote cite="ftp://x">f</blockquote><a href="#t">t</a>'
    '<a href="//h.example/z">h</a><a href="rel/./a/../b">r</a>',
    "<div><p>one <q>two</div>three</q></p><blockquote>four <p>five",
    '<a href="x>y" title="<q>">six</a><span data-x=\'</span>\'><q>seven</span>eight</q>',
    "<ul><li><p>nine<li><q>ten</ul>eleven<h1>a<h2>b</h1>c</h2><a href=m>d<a href=n>e",
    "<table><tr><td><p>f</b><td>g<blockquote>h</table>i</blockquote></p>j<h3>k<p>l</h3>m",
)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with odd markup at their ends."""
    end = F.get(
        F.array(*map(F.lit, ODD_MARKUP)), (F.col("page_id") % len(ODD_MARKUP)).cast("int")
    )
    rows = table(spark, sf_dir, "pages")
    return rows.withColumn("html", F.concat("html", end))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema RAW with web pages as payloads: as they are in the feed, with
    quotations in the extract."""

    def payload(html: Column) -> Column:
        return F.struct(F.lit("zlib").alias("encoding"), deflate(html).alias("data"))

    link = F.struct(F.col("url").alias("href"))
    empty = F.struct(F.lit("web").alias("publisherType"))
    feed_entry = F.struct(
        F.col("page_id").alias("identifier"),
        link.alias("canonicalLink"),
        payload(F.col("html")).alias("content"),
    )
    permalink = F.struct(
        (F.col("page_id") * 2 + 1).alias("identifier"),
        link.alias("canonicalLink"),
        payload(quote_tags(F.col("html"))).alias("contentExtract"),
    )
    rows = pages(spark, sf_dir).select(
        empty.alias("source"), feed_entry.alias("feedEntry"), permalink.alias("permalinkEntry")
    )
    return filled(rows, RAW)


def filled(rows: DataFrame, schema: str) -> DataFrame:
    """Rows with all fields of a schema; those they lack are null."""

    def field(have: StructType | None, want: DataType, value: Column | None) -> Column:
        if value is None:
            return F.lit(None).cast(want)
        if not isinstance(want, StructType):
            return value.cast(want)
        there = {f.name: f.dataType for f in have.fields}
        return F.struct(
            *[
                field(there.get(f.name), f.dataType, value[f.name] if f.name in there else None)
                .alias(f.name)
                for f in want.fields
            ]
        )

    want = StructType.fromDDL(schema)
    there = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(
        *[
            field(there.get(f.name), f.dataType, F.col(f.name) if f.name in there else None)
            .alias(f.name)
            for f in want.fields
        ]
    )


def write_skewed_copy(
    spark: SparkSession, sf_dir: str, folder: str, copies: int
) -> None:
    """The text tables ``copies`` times over, a third of the rows with one key.

    A third of the documents is empty, a third of the turns belongs to one
    conversation, and a third of the pages is one page. Ids of documents and
    pages stay unique.
    """

    def copied(name: str) -> DataFrame:
        number = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        rows = table(spark, sf_dir, name).select("*", number.alias("copy"))
        return rows.withColumn("hot", F.col("copy") % 3 == 0)

    def unique(key: str) -> Column:
        return (F.col(key) * copies + F.col("copy")).alias(key)

    hot_text = F.when(F.col("hot"), "").otherwise(F.concat_ws(" ", "copy", "text"))
    tables = {
        "documents": copied("documents").select(
            unique("doc_id"), hot_text.alias("text"), "lang", "source", "n_chars"
        ),
        "conversations": copied("conversations").select(
            F.when(F.col("hot"), 5).otherwise(unique("conv_id")).alias("conv_id"),
            "turn",
            "role",
            "text",
        ),
        "pages": copied("pages").select(
            unique("page_id"),
            "url",
            F.when(F.col("hot"), "<p>one <b>page</b>").otherwise(F.col("html"))
            .alias("html"),
        ),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")


#: An archive of the fixtures is closed at this many members.
ARCHIVE_MEMBERS = 2_000


def write_archives(members: DataFrame) -> str:
    """Write rows ``(member, data)`` as tar.gz files; returns their glob.

    Each task writes its own files, named by its partition, and a task that is
    run again writes the same ones.
    """
    staged = stage(members.select("member", "data"))
    # Where Spark put the table, scheme included, is where the archives go.
    folder = staged.inputFiles()[0].rsplit("/", 1)[0] + "-archives"

    def pack(partition: int, rows: Iterator[Row]) -> Iterator[str]:
        filesystem, root = FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))
        filesystem.create_dir(root, recursive=True)
        for number in count():
            # One member in memory at a time.
            part = islice(rows, ARCHIVE_MEMBERS)
            first = next(part, None)
            if first is None:
                return
            name = f"{root}/part-{partition:05d}-{number:05d}.tar.gz"
            with (
                filesystem.open_output_stream(name, compression=None) as out,
                tarfile.open(fileobj=out, mode="w|gz", compresslevel=1) as archive,
            ):
                records = tarfile.TarInfo("records")
                records.type = tarfile.DIRTYPE
                archive.addfile(records)
                for member, data in chain([first], part):
                    info = tarfile.TarInfo(f"records/{member}")
                    info.size = len(data)
                    archive.addfile(info, io.BytesIO(data))
            yield name

    staged.rdd.mapPartitionsWithIndex(pack).count()
    return f"{folder}/*.tar.gz"

"""One query per operator, on the test tables.

Token lists are returned as text and size, so that no engine's array format
matters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from whosaid.functions.html import clean_html, html_tokens
from whosaid.functions.payload import inflate_content, is_unread
from whosaid.functions.quotations import find_quotations, span_pairs, tag_quotation
from whosaid.functions.tokens import fix_content, tokenize, tokenize_raw, untokenize
from whosaid.operators.articles import (
    cast_id,
    explode_occurrences,
    explode_quotations,
    filter_publisher,
    project_articles,
    repartition_rows,
    sample_rows,
)
from whosaid.operators.dedupe import dedupe_content, dedupe_pairs
from whosaid.operators.entries import normalize_entries
from whosaid.operators.joins import join_articles, join_mapping, join_speakers
from whosaid.operators.metrics import RunMetrics, committed_rows
from whosaid.plans.extract import extract_articles as extract_plan
from whosaid.plans.ingest import ingest_archives as ingest_archives_plan
from whosaid.plans.ingest import ingest_entries as ingest_plan
from whosaid.plans.mapping import map_discarded as map_plan
from whosaid.plans.tagging import tag_articles
from whosaid.plans.tagging import tag_corpus as tag_plan
from whosaid.schemas import ENTRY
from whosaid.sources import archives, scans
from whosaid.sources.sinks import stage, work_folder
from whosaid.sources.sinks import write_json as write_json_sink
from whosaid.sources.sinks import write_parquet as write_parquet_sink
from whosaid.workloads import adapters as given

Query = Callable[[SparkSession, str], DataFrame]

#: The publishers, rate and seed that the filter and sample queries use.
PUBLISHERS = ("src0", "src3", "src7")
FRACTION = 0.2
SEED = 7


def shown(tokens: str | Column, name: str) -> list[Column]:
    """A token list as its text and its size."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return [
        F.array_join(tokens, " ").alias(name),
        F.size(tokens).cast("bigint").alias(f"{name}_size"),
    ]


def digested(tokens: str, name: str) -> list[Column]:
    """A long token list as the digest of its text, and its size."""
    text, size = shown(tokens, name)
    return [F.md5(F.array_join(tokens, " ")).alias(name), size]


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "documents").select("doc_id", "text")


# Sources and sinks: the tables are written in the format, then read.


def scan_articles(spark, sf_dir):
    path = work_folder(spark)
    write_json_sink(given.entries(spark, sf_dir), path, codec="GzipCodec")
    articles = project_articles(scans.scan_articles(spark, f"{path}/*.gz"))
    return articles.select("articleUID", *shown("content", "content"))


def scan_attributions(spark, sf_dir):
    path = work_folder(spark)
    write_json_sink(given.attributions(spark, sf_dir), path)
    return explode_occurrences(scans.scan_attributions(spark, path), True)


def scan_mapping(spark, sf_dir):
    path = work_folder(spark)
    write_json_sink(given.mapping(spark, sf_dir), path, codec="GzipCodec")
    return scans.scan_mapping(spark, path)


def _as_lines(rows: DataFrame, quoted: DataFrame) -> DataFrame:
    """Both tables as JSON lines."""
    lines = [df.select(F.to_json(F.struct("*"))) for df in (rows, quoted)]
    return lines[0].union(lines[1])


def scan_attributions_quoted(spark, sf_dir):
    """Every other row with its numbers as text."""
    path = work_folder(spark)
    rows = given.attributions(spark, sf_dir)
    odd = F.pmod(F.xxhash64("speaker"), F.lit(2)) == 1
    quoted = rows.where(odd).withColumn(
        "occurrences",
        F.transform(
            "occurrences",
            lambda o: o.withField("patternConfidence", o["patternConfidence"].cast("string")),
        ),
    )
    _as_lines(rows.where(~odd), quoted).write.text(path)
    return explode_occurrences(scans.scan_attributions(spark, path), True)


def scan_mapping_quoted(spark, sf_dir):
    """Every other row with its numbers as text."""
    path = work_folder(spark)
    rows = given.mapping(spark, sf_dir)
    odd = F.pmod("articleUID", F.lit(2)) == 1
    text = {c: F.col(c).cast("string") for c in ("articleUID", "confidence")}
    _as_lines(rows.where(~odd), rows.where(odd).withColumns(text)).write.text(path)
    return scans.scan_mapping(spark, path)


def _with_broken_lines(df: DataFrame, broken: Column) -> DataFrame:
    """JSON lines, and behind some of them the same line cut short, or no JSON."""
    line = F.to_json(F.struct("*"))
    cut = F.when(F.length(line) % 2 == 0, F.concat(F.lit("x"), line)).otherwise(
        F.expr("left(to_json(struct(*)), 40)")
    )
    lines = F.when(broken, F.array(line, cut)).otherwise(F.array(line))
    return df.select(F.explode(lines).alias("value"))


def scan_articles_kept(spark, sf_dir):
    """Articles among broken lines, and a last row with the number of these."""
    path = work_folder(spark)
    entries = given.entries(spark, sf_dir)
    broken = F.col("feedEntry.identifier").cast("bigint") % 7 == 3
    _with_broken_lines(entries, broken).write.option("compression", "gzip").text(path)
    run = RunMetrics()
    rows = scans.good_rows(scans.scan_articles(spark, f"{path}/*.gz", on_error="keep"), run)
    articles = project_articles(rows)
    good = stage(articles.select("articleUID", *shown("content", "content")))
    corrupt = run.report()["corrupt"]
    count = spark.createDataFrame([("corrupt", "", corrupt)], good.schema)
    return good.union(count)


def scan_mapping_kept(spark, sf_dir):
    """The mapping among broken lines, and a last row with the number of these."""
    path = work_folder(spark)
    mapping = given.mapping(spark, sf_dir)
    _with_broken_lines(mapping, F.col("articleUID") % 5 == 2).write.text(path)
    run = RunMetrics()
    good = stage(scans.good_rows(scans.scan_mapping(spark, path, on_error="keep"), run))
    corrupt = run.report()["corrupt"]
    return good.union(spark.createDataFrame([(corrupt, "corrupt", 0.0, "")], good.schema))


def committed(spark, sf_dir):
    """What two jobs left, by the files they committed."""
    entries = given.entries(spark, sf_dir)
    paths = {form: work_folder(spark) for form in ("json", "parquet")}
    write_json_sink(entries, paths["json"], codec="GzipCodec", partitions=3)
    write_parquet_sink(entries.where(F.col("source.publisherType") != "src0"), paths["parquet"])
    counts = [(form, committed_rows(spark, path, form)) for form, path in paths.items()]
    return spark.createDataFrame(counts, "form string, documents bigint")


def scan_archives(spark, sf_dir):
    members = _texts(spark, sf_dir).select(
        F.concat("doc_id", F.lit(".txt")).alias("member"),
        F.encode("text", "UTF-8").alias("data"),
    )
    files = given.write_archives(members)
    return archives.scan_archives(spark, files).select(
        F.regexp_extract("member", r"records/(\d+)\.txt", 1)
        .cast("bigint")
        .alias("doc_id"),
        F.decode("data", "UTF-8").alias("text"),
    )


def inflate(spark, sf_dir):
    documents = given.table(spark, sf_dir, "documents")
    encoding = F.when(F.col("lang") == "fr", "identity").otherwise("zlib")
    packed = documents.select(
        "doc_id",
        encoding.alias("encoding"),
        given.deflate(F.col("text")).alias("data"),
    )
    return packed.select(
        "doc_id", inflate_content(F.col("data"), F.col("encoding")).alias("text")
    )


def write_parquet(spark, sf_dir):
    path = work_folder(spark)
    write_parquet_sink(given.articles(spark, sf_dir), path)
    return spark.read.parquet(path).select("articleUID", *shown("content", "content"))


def write_json(spark, sf_dir):
    path = work_folder(spark)
    write_json_sink(given.entries(spark, sf_dir), path, partitions=4)
    return _flat_entries(scans.scan_articles(spark, path, ENTRY))


def _write_json_with(codec: str) -> Query:
    def query(spark, sf_dir):
        path = work_folder(spark)
        write_json_sink(given.articles(spark, sf_dir), path, codec=codec)
        back = spark.read.schema("articleUID string, content array<string>")
        return back.json(path).select("articleUID", *shown("content", "content"))

    return query


def write_json_single_file(spark, sf_dir):
    path = work_folder(spark)
    report = (
        given.table(spark, sf_dir, "documents")
        .groupBy("lang", "source")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    # One file, as the report has a row per language and source.
    write_json_sink(report, path, partitions=1)
    schema = "lang string, source string, documents bigint"
    return spark.read.schema(schema).json(f"{path}/part-*.json")


# Projections, filters, generators.


def project(spark, sf_dir):
    articles = project_articles(given.entries(spark, sf_dir))
    return articles.select("articleUID", *shown("content", "content"))


def _flat_entries(entries: DataFrame) -> DataFrame:
    """Every field of an entry, as columns."""
    columns = [
        F.col(f"{record}.{field}").alias(f"{record}_{field}")
        for record in entries.columns
        for field in entries.schema[record].dataType.names
        if field != "tokenizedContent"
    ]
    for record in ("feedEntry", "permalinkEntry"):
        columns += shown(f"{record}.tokenizedContent", f"{record}_content")
    return entries.select(columns)


def normalize(spark, sf_dir):
    raw = given.raw_records(spark, sf_dir)
    return _flat_entries(normalize_entries(raw, clean=False, tokenize=False))


def cast_ids(spark, sf_dir):
    seen = explode_occurrences(given.attributions(spark, sf_dir))
    return seen.select(
        "articleUID", cast_id(F.col("articleUID")).alias("number"), "extractedBy"
    )


def publisher(spark, sf_dir):
    kept = filter_publisher(given.entries(spark, sf_dir), PUBLISHERS)
    return kept.select(
        F.col("feedEntry.identifier").alias("articleUID"),
        F.col("source.publisherType").alias("publisher"),
    )


def sample(spark, sf_dir):
    texts = _texts(spark, sf_dir)
    return sample_rows(texts, FRACTION, SEED, key=F.col("doc_id"))


def repartition(spark, sf_dir):
    return repartition_rows(_texts(spark, sf_dir), 16)


def occurrences(spark, sf_dir):
    return explode_occurrences(given.attributions(spark, sf_dir), keep_canonical=True)


def _with_spans(spark, sf_dir) -> DataFrame:
    # One row per span carries the content, so it is computed ahead of them.
    fixed = stage(
        given.articles(spark, sf_dir).select(
            "articleUID", fix_content(F.col("content")).alias("content")
        )
    )
    spans = find_quotations(F.col("content"))
    return fixed.select("articleUID", "content", spans.alias("quotationIndexes"))


def quotations(spark, sf_dir):
    rows = explode_quotations(_with_spans(spark, sf_dir))
    return rows.select(
        "articleUID",
        F.col("quotationIndex.start").cast("bigint").alias("start"),
        F.col("quotationIndex.end").cast("bigint").alias("end"),
        F.size("quotationIndexes").cast("bigint").alias("spans"),
    )


# Joins and duplicate removal.


def articles_joined(spark, sf_dir):
    seen = explode_occurrences(given.attributions(spark, sf_dir))
    joined = join_articles(given.articles(spark, sf_dir), seen)
    return joined.select(
        "articleUID",
        "speaker",
        "extractedBy",
        "patternConfidence",
        "quotation",
        *digested("content", "content"),
    )


def mapping_joined(spark, sf_dir):
    links = given.mapping(spark, sf_dir)
    joined = join_mapping(given.articles(spark, sf_dir), links)
    return joined.select(
        "articleUID",
        "canonicalQuotationDestination",
        "canonicalQuotationSource",
        "confidence",
        *digested("content", "content"),
    )


def _occurrences_by_quotation(spark, sf_dir) -> DataFrame:
    seen = explode_occurrences(given.attributions(spark, sf_dir), keep_canonical=True)
    return seen.select(
        "canonicalQuotation", "speaker", F.col("articleUID").alias("seen_in"), "extractedBy"
    )


def _speaker_pairs(spark, sf_dir) -> DataFrame:
    """Every occurrence with every link, and the linked article's content."""
    seen = _occurrences_by_quotation(spark, sf_dir)
    merged = join_mapping(given.articles(spark, sf_dir), given.mapping(spark, sf_dir))
    return join_speakers(seen, merged)


def speakers_joined(spark, sf_dir):
    return _speaker_pairs(spark, sf_dir).select(
        "articleUID",
        "speaker",
        "canonicalQuotation",
        "canonicalQuotationSource",
        "confidence",
        "seen_in",
        "extractedBy",
        *digested("content", "content"),
    )


def pairs_deduped(spark, sf_dir):
    """Every occurrence with every link, once per pair, and the linked article's
    content, which joins the pairs that remain."""
    seen = _occurrences_by_quotation(spark, sf_dir)
    pairs = join_speakers(seen, given.mapping(spark, sf_dir)).withColumnRenamed(
        "canonicalQuotationSource", "quotation"
    )
    rows = dedupe_pairs(pairs, given.articles(spark, sf_dir))
    return rows.select(
        "articleUID", "speaker", "quotation", "confidence", *digested("content", "content")
    )


def content_deduped(spark, sf_dir):
    kept = dedupe_content(given.entries(spark, sf_dir))
    return kept.select(
        F.col("permalinkEntry.identifier").alias("identifier"),
        *shown("permalinkEntry.tokenizedContent", "content"),
    )


def metrics(spark, sf_dir):
    run = RunMetrics()
    raw = run.watch(
        given.raw_records(spark, sf_dir),
        unread=is_unread(F.col("permalinkEntry.contentExtract")),
    )
    entries = normalize_entries(raw, clean=False, tokenize=False)
    write_json_sink(entries, work_folder(spark))
    report = run.report()
    return spark.createDataFrame(
        [(report["documents"], report["unread"])], "documents bigint, unread bigint"
    )


# Text functions.


def raw_tokens(spark, sf_dir):
    tokens = _texts(spark, sf_dir).select(
        "doc_id", tokenize_raw(F.col("text")).alias("tokens")
    )
    return tokens.select("doc_id", *shown("tokens", "tokens"))


def repaired_tokens(spark, sf_dir):
    tokens = _texts(spark, sf_dir).select(
        "doc_id", tokenize(F.col("text")).alias("tokens")
    )
    return tokens.select("doc_id", *shown("tokens", "tokens"))


def _fixed(mode: str) -> Query:
    def query(spark, sf_dir):
        fixed = _texts(spark, sf_dir).select(
            "doc_id",
            fix_content(given.odd_tokens(F.col("text")), mode).alias("tokens"),
        )
        return fixed.select("doc_id", *shown("tokens", "tokens"))

    return query


def spans_found(spark, sf_dir):
    spans = given.articles(spark, sf_dir).select(
        "articleUID",
        F.explode(span_pairs(find_quotations(F.col("content")))).alias("span"),
    )
    return spans.select(
        "articleUID",
        F.col("span")[0].cast("bigint").alias("start"),
        F.col("span")[1].cast("bigint").alias("end"),
    )


def quotations_tagged(spark, sf_dir):
    rows = explode_quotations(_with_spans(spark, sf_dir))
    tagged = rows.select(
        "articleUID",
        tag_quotation(
            F.col("content"), F.col("quotationIndexes"), F.col("quotationIndex")
        ).alias("tagged"),
    ).select("articleUID", "tagged.content", "tagged.quotation")
    return tagged.select(
        "articleUID", *digested("content", "content"), *shown("quotation", "quotation")
    )


def html_cleaned(spark, sf_dir):
    return given.pages(spark, sf_dir).select(
        "page_id", clean_html(F.col("html"), F.col("url")).alias("html")
    )


def html_cleaned_tokens(spark, sf_dir):
    cleaned = clean_html(F.col("html"), F.col("url"))
    tokens = given.pages(spark, sf_dir).select(
        "page_id", fix_content(tokenize_raw(cleaned)).alias("tokens")
    )
    return tokens.select("page_id", *shown("tokens", "tokens"))


def html_tokens_native(spark, sf_dir):
    quoted = given.quote_tags(F.col("html"))
    tokens = given.pages(spark, sf_dir).select(
        "page_id", html_tokens(quoted, F.col("url")).alias("tokens")
    )
    return tokens.select("page_id", *shown("tokens", "tokens"))


def text_restored(spark, sf_dir):
    return _texts(spark, sf_dir).select(
        "doc_id", untokenize(tokenize_raw(F.col("text"))).alias("text")
    )


# The jobs.


def extract(spark, sf_dir):
    rows = extract_plan(given.entries(spark, sf_dir), given.attributions(spark, sf_dir))
    return rows.select(
        "articleUID",
        "extractedBy",
        "patternConfidence",
        "speaker",
        *digested("content", "content"),
        *shown("quotation", "quotation"),
    )


def map_discarded(spark, sf_dir):
    rows = map_plan(
        given.entries(spark, sf_dir),
        given.attributions(spark, sf_dir),
        given.mapping(spark, sf_dir),
    )
    return rows.select(
        "articleUID",
        "confidence",
        "speaker",
        *digested("content", "content"),
        *shown("quotation", "quotation"),
    )


def _tag_output(rows: DataFrame) -> DataFrame:
    return rows.select(
        "articleUID", *digested("content", "content"), *shown("quotation", "quotation")
    )


def tag_corpus(spark, sf_dir):
    return _tag_output(tag_plan(given.entries(spark, sf_dir)))


def tag_corpus_sample(spark, sf_dir):
    entries = given.entries(spark, sf_dir)
    return _tag_output(tag_plan(entries, fraction=FRACTION, seed=SEED))


def tag_corpus_odd(spark, sf_dir):
    articles = given.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("articleUID"),
        given.odd_tokens(F.col("text")).alias("content"),
    )
    return _tag_output(tag_articles(articles))


def _ingested(entries: DataFrame) -> DataFrame:
    return entries.select(
        F.col("source.publisherType").alias("publisher"),
        F.col("feedEntry.identifier").alias("feed_id"),
        *digested("feedEntry.tokenizedContent", "feed_content"),
        F.col("permalinkEntry.identifier").alias("permalink_id"),
        *digested("permalinkEntry.tokenizedContent", "permalink_content"),
    )


def ingest(spark, sf_dir):
    return _ingested(ingest_plan(given.raw_records(spark, sf_dir), partitions=4))


def ingest_filtered(spark, sf_dir):
    return _ingested(ingest_plan(given.raw_records(spark, sf_dir), types=PUBLISHERS))


def ingest_sampled(spark, sf_dir):
    raw = given.raw_records(spark, sf_dir)
    return _ingested(ingest_plan(raw, fraction=FRACTION, seed=SEED))


def ingest_distinct(spark, sf_dir):
    return _ingested(ingest_plan(given.raw_records(spark, sf_dir), dedupe=True))


def ingest_html(spark, sf_dir):
    return _ingested(ingest_plan(given.raw_pages(spark, sf_dir)))


def ingest_archives(spark, sf_dir):
    raw = given.raw_records(spark, sf_dir)
    members = raw.select(
        F.concat("feedEntry.identifier", F.lit(".json")).alias("member"),
        F.encode(F.to_json(F.struct("*")), "UTF-8").alias("data"),
    )
    files = given.write_archives(members)
    return _ingested(ingest_archives_plan(spark, files))


QUERIES: dict[str, Query] = {
    "tag_corpus": tag_corpus,
    "tag_corpus_odd_tokens": tag_corpus_odd,
    "tag_corpus_sample": tag_corpus_sample,
    "extract_articles": extract,
    "map_discarded": map_discarded,
    "ingest_entries": ingest,
    "ingest_entries_distinct": ingest_distinct,
    "ingest_entries_filtered": ingest_filtered,
    "ingest_entries_sampled": ingest_sampled,
    "ingest_html": ingest_html,
    "ingest_archives": ingest_archives,
    "scan_articles": scan_articles,
    "scan_attributions": scan_attributions,
    "scan_mapping": scan_mapping,
    "scan_attributions_quoted": scan_attributions_quoted,
    "scan_mapping_quoted": scan_mapping_quoted,
    "scan_articles_kept": scan_articles_kept,
    "scan_mapping_kept": scan_mapping_kept,
    "scan_archives": scan_archives,
    "inflate_content": inflate,
    "write_parquet": write_parquet,
    "write_json": write_json,
    "write_json_gzip": _write_json_with("GzipCodec"),
    "write_json_lz4": _write_json_with("Lz4Codec"),
    "write_json_bzip2": _write_json_with("BZip2Codec"),
    "write_json_snappy": _write_json_with("SnappyCodec"),
    "write_json_single_file": write_json_single_file,
    "repartition_rows": repartition,
    "project_articles": project,
    "normalize_entries": normalize,
    "cast_id": cast_ids,
    "filter_publisher": publisher,
    "sample_rows": sample,
    "explode_occurrences": occurrences,
    "explode_quotations": quotations,
    "join_articles": articles_joined,
    "join_mapping": mapping_joined,
    "join_speakers": speakers_joined,
    "dedupe_pairs": pairs_deduped,
    "dedupe_content": content_deduped,
    "run_metrics": metrics,
    "committed_rows": committed,
    "tokenize_raw": raw_tokens,
    "tokenize": repaired_tokens,
    "fix_content": _fixed("reference"),
    "fix_content_clean": _fixed("clean"),
    "find_quotations": spans_found,
    "tag_quotation": quotations_tagged,
    "clean_html": html_cleaned,
    "clean_html_tokens": html_cleaned_tokens,
    "html_tokens": html_tokens_native,
    "untokenize": text_restored,
}

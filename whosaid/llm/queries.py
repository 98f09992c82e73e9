"""The training-data operators as queries over whole tables, and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from whosaid.llm.chat import as_records, canonical_turns, digests, format_chats
from whosaid.llm.decontaminate import contamination, near_passages
from whosaid.llm.fingerprints import fingerprints
from whosaid.llm.jaccard_join import jaccard_components, jaccard_degrees
from whosaid.llm.licenses import license_matches
from whosaid.llm.merkle import merkle_manifest
from whosaid.llm.mixing import Level, mixed
from whosaid.llm.passages import repeated_passages, with_rows
from whosaid.llm.quality import THRESHOLD, held_out, measured, scored_statistics, train
from whosaid.llm.repair import repair_report
from whosaid.llm.sharding import shards, text_order
from whosaid.llm.sql import SQL
from whosaid.llm.suffix_dedup import remove_repeats
from whosaid.llm.tables import stored, table
from whosaid.llm.token_counts import read_vocabulary, token_counts

#: The vocabulary whose pieces op5 counts.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share nine tenths of their three-word shingles."""
    return jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op1_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with each document's number of links."""
    return jaccard_degrees(table(spark, sf_dir, "documents"), k=3, percent=90)


def shard_dims() -> list[Column]:
    """The metadata of documents by which shards are cut."""
    return [
        text_order(F.col("lang")),
        text_order(F.col("source")),
        F.log1p(F.octet_length("text")),
    ]


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes, by language, source and length."""
    docs = table(spark, sf_dir, "documents")
    return shards(docs, shard_dims(), n_shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in strings of 200 bytes that occur twice."""
    cut = remove_repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]
    )
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of documents, and how near an edit and the next one are."""
    return fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op5_token_counts(
    spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY
) -> DataFrame:
    """The number of pieces of every document."""
    return token_counts(table(spark, sf_dir, "documents"), read_vocabulary(vocabulary))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in documents, with their spans."""
    return license_matches(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from three quarters of the labels."""
    # Texts are read once: their statistics are learned from and scored.
    statistics = stored(measured(table(spark, sf_dir, "documents"), ["doc_id"]))
    model = train(statistics, table(spark, sf_dir, "labels"))
    return scored_statistics(statistics, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that tries the escapes, formatted and read back."""
    columns = ["conv_id", "turn", "role", "text"]
    tricky = spark.createDataFrame(
        [(-1, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select(columns).unionByName(tricky)
    turns = canonical_turns(as_records(rows), ["conv_id", "turn"])
    return digests(format_chats(turns))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of benchmark items."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with all words of a window of a benchmark item close together."""
    found = near_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_near",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )


def mixture_levels() -> list[Level]:
    """A tree over documents: four domains by the source's number, then
    languages, then sources."""
    number = F.coalesce(
        F.expr("try_cast(regexp_extract(source, '([0-9]+)', 1) AS int)"), F.lit(0)
    )
    return [
        ("domain", F.concat(F.lit("d"), number % 4), 4 - number % 4),
        ("lang", F.col("lang"), F.when(F.col("lang") == "en", 5).otherwise(2)),
        ("source", F.col("source"), 1 + number % 3),
    ]


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as there are, at the target weights, at most twice each."""
    rows = mixed(table(spark, sf_dir, "documents"), mixture_levels(), F.col("total"))
    return rows.select(
        "doc.doc_id",
        F.col("node_domain").alias("domain"),
        F.col("node_lang").alias("lang"),
        F.col("node_source").alias("source"),
        "tokens",
        "budget",
        F.col("epoch").cast("long").alias("epoch"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of conversations, one in four damaged in one of five ways."""
    given = conversations.select(
        "conv_id",
        "turn",
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    place = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(place[0], F.lit(":"), place[1])) % 20
    text = F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.translate("text", ".!?", "")
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        given.withColumn("kind", kind)
        .where("kind <> 0")
        .withColumn("copy", F.explode(copies))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.otherwise(F.col("text")).alias("text"),
        )
    )


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repairs of all conversations, after some damage."""
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(damaged(conversations), conversations.select("conv_id"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents; a third is checked with lower-cased text."""
    fold = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    crc = F.crc32(F.col("doc_id").cast("string"))
    text = F.when(crc % 3 == 0, fold).otherwise(F.col("text"))
    manifest = merkle_manifest(table(spark, sf_dir, "documents"), checked={"text": text})
    return manifest.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op13_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in passages of 35 words that occur twice."""
    docs = table(spark, sf_dir, "documents")
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]
    )
    cut = repeated_passages(docs).select(
        "digest",
        "n_words",
        removed.alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    return with_rows(docs, stored(cut))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_sharding": op2_sharding,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_fingerprints": op4_fingerprints,
    "op5_token_counts": op5_token_counts,
    "op6_licenses": op6_licenses,
    "op7_quality": op7_quality,
    "op8_chat": op8_chat,
    "op9_decontaminate": op9_decontaminate,
    "op10_mixing": op10_mixing,
    "op11_repair": op11_repair,
    "op12_merkle": op12_merkle,
    "op13_passages": op13_passages,
}

#: Further results of the same operators, beside the columns of their contracts.
MORE: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_links": op1_links,
    "op9_proximity": op9_proximity,
}

ORACLES: dict[str, str] = dict(SQL)

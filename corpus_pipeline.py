"""A training corpus in five stages, from documents to shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from whosaid.llm.decontaminate import contamination
from whosaid.llm.jaccard_join import jaccard_components
from whosaid.llm.mixing import mixed
from whosaid.llm.quality import THRESHOLD, measured, scored, train
from whosaid.llm.queries import mixture_levels, shard_dims
from whosaid.llm.sharding import shards
from whosaid.llm.tables import numbered, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    It learns from the labelled documents of the corpus that are not held out,
    and scores each row of ``docs`` by its text, repeated ones alike; a null text
    is an empty one. Other columns pass as they are, whatever their names. An
    empty table stays empty.
    """
    learned_from = measured(table(spark, sf_dir, "documents"), ["doc_id"])
    model = train(learned_from, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("doc"), "text")
    return scored(rows, model, ["doc"]).where(F.col("score") >= THRESHOLD).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that shares four fifths of its five-word shingles:
    the one with the smallest doc_id, and of several the first. Rows without a
    doc_id come last in their group; documents without words stay. Other columns
    pass as they are, and an empty table stays empty."""
    rows = numbered(docs)
    groups = jaccard_components(
        rows.select(F.col("row").alias("doc_id"), "doc.text"), k=5, percent=80
    ).select(F.col("doc_id").alias("row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    kept = (
        groups.join(rows.select("row", "doc.doc_id"), "row")
        .groupBy("component_id")
        .agg(F.min(order)["row"].alias("row"))
    )
    dropped = stored(rows.select("row").join(kept, "row", "left_anti"))
    return rows.join(dropped, "row", "left_anti").select("doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of ten words of a benchmark item, each by its own
    text, whatever its doc_id. Other columns pass as they are, and an empty table
    stays empty."""
    rows = numbered(docs)
    found = contamination(
        rows.select(F.col("row").alias("doc_id"), "doc.text"), table(spark, sf_dir, "benchmark")
    )
    dropped = found.where("n_hit > 0").select(F.col("doc_id").alias("row"))
    return rows.join(dropped, "row", "left_anti").select("doc.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, at the target weights, each document at
    most twice. A null in a column of the tree is a node like any other, repeated
    rows are rows of their own, and an empty table stays empty."""
    return mixed(docs, mixture_levels(), F.col("total")).select("doc.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus in eight shards of near equal bytes. A null text has one byte, a
    null in another column the lowest place; repeated rows are rows of their own."""
    return shards(docs, shard_dims(), n_shards=8).select("doc_id", "size", "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixture),
    ("sharding", sharding),
]

#: A trained classifier has no statement in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents, each stored as a table
    of the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), release=True)
    return docs

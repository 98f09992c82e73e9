"""JSON scans with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from whosaid.operators.metrics import RunMetrics
from whosaid.schemas import ARTICLE, ATTRIBUTIONS_TEXT, MAPPING_TEXT

#: The column of a line that is no record, where such lines are kept.
CORRUPT = "_corrupt_record"


def _read(
    spark: SparkSession, path: str | list[str], schema: str | StructType, on_error: str
) -> DataFrame:
    """JSON lines of a schema whose leaves are text.

    A line that is no record fails the job. With ``on_error="keep"`` it is a row of
    nulls with the line in a further column, for ``good_rows``.
    """
    if on_error not in ("fail", "keep"):
        raise ValueError(f"on_error must be 'fail' or 'keep', not {on_error!r}")
    if on_error == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = StructType([*fields.fields, StructField(CORRUPT, StringType())])
    read = spark.read.schema(kept).option("mode", "PERMISSIVE")
    return read.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def good_rows(rows: DataFrame, run: RunMetrics) -> DataFrame:
    """The records of a scan with ``on_error="keep"``.

    ``run`` counts all lines as ``documents`` and those that are no records as
    ``corrupt``, while the job runs.
    """
    no_record = F.col(CORRUPT).isNotNull()
    return run.watch(rows, corrupt=no_record).where(~no_record).drop(CORRUPT)


def scan_articles(
    spark: SparkSession,
    path: str | list[str],
    schema: str | StructType = ARTICLE,
    partitions: int = 0,
    on_error: str = "fail",
) -> DataFrame:
    """Article JSON lines, gzip or plain, by path or glob.

    A gzip file is one task, whatever its size; ``partitions`` spreads the rows
    of few large files before the costly steps, and 0 shuffles nothing. Pass
    schema ENTRY for whole entries.
    """
    articles = _read(spark, path, schema, on_error)
    return articles.repartition(partitions) if partitions > 0 else articles


def scan_attributions(
    spark: SparkSession, path: str | list[str], on_error: str = "fail"
) -> DataFrame:
    """Quotations with speaker and occurrences.

    Numbers may be written bare or quoted; text that is no number is null.
    """

    def typed(o: Column) -> Column:
        return F.struct(
            o["articleUID"].alias("articleUID"),
            o["quotation"].alias("quotation"),
            o["extractedBy"].alias("extractedBy"),
            o["patternConfidence"].try_cast("double").alias("patternConfidence"),
        )

    rows = _read(spark, path, ATTRIBUTIONS_TEXT, on_error)
    return rows.withColumn("occurrences", F.transform("occurrences", typed))


def scan_mapping(
    spark: SparkSession, path: str | list[str], on_error: str = "fail"
) -> DataFrame:
    """Discarded pairs with the quotation that stands for them.

    Numbers may be written bare or quoted; text that is no number is null.
    """
    rows = _read(spark, path, MAPPING_TEXT, on_error)
    return rows.withColumns(
        {
            "articleUID": F.col("articleUID").try_cast("bigint"),
            "confidence": F.col("confidence").try_cast("double"),
        }
    )

"""The given tables, and stored tables that cut lineage in the shared folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from whosaid.sources.sinks import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's settings for a table that is made in little space: the shuffle files of a
#: query go when it ends, and Python workers get fewer rows at a time.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def stored(df: DataFrame, release: bool = False) -> DataFrame:
    """The rows, computed once and kept as a table in the shared folder that
    ``spark.checkpoint.dir`` names, so that they survive a lost executor. The
    table is deleted when the application ends. ``release`` deletes the shuffles
    that made it, which nothing reads again, when it is written."""
    path = work_folder(df.sparkSession)
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in LEAN} if release else {}
    try:
        for k in before:
            conf.set(k, LEAN[k])
        df.write.parquet(path)
    finally:
        for k, value in before.items():
            conf.set(k, value)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


#: Bits of a row's number for its place in its file; the rest is the file's.
_PLACE = 36


def numbered(df: DataFrame) -> DataFrame:
    """Each row as (row, doc): a number, which is the same whenever and in whatever
    parts the rows are read, and a struct of all its columns, whatever their names.

    The number is made of the part number in the name of the row's file, as Spark
    writes it, and the row's place in the file. What is no table of such files,
    each with a number of its own, is stored first.
    """
    known = _numbers(df)
    if known is None:
        known = _numbers(stored(df.select(F.struct("*").alias("doc"))))
        return known.select("row", "doc.doc")
    return known


def _numbers(df: DataFrame) -> DataFrame | None:
    if "_metadata" in map(str.lower, df.columns):
        return None
    # Rows of a plan above a scan may share a place, as those of an explode do.
    plan = df._jdf.queryExecution().analyzed().getClass().getSimpleName()
    if plan != "LogicalRelation":
        return None
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)-.*-c000\.", 1).try_cast("long")
    row = F.shiftleft(part, _PLACE) + F.col("_metadata.row_index")
    try:
        files = df.agg(
            F.count_distinct("_metadata.file_path").alias("files"),
            F.count_distinct(part).alias("parts"),
            F.count_if(part.isNull()).alias("others"),
        ).first()
    except AnalysisException:
        return None
    if files["others"] or files["files"] != files["parts"]:
        return None
    return df.select(row.alias("row"), F.struct("*").alias("doc"))


def drop(df: DataFrame) -> None:
    """Delete a stored table that no unread result needs."""
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(where, True)

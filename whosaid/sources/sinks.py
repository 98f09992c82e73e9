"""Sinks, and the folder for tables between two steps of a job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from whosaid.operators.articles import repartition_rows

# The output codecs, by codec class and by Spark's short name.
CODECS = {
    "GzipCodec": "gzip",
    "Lz4Codec": "lz4",
    "BZip2Codec": "bzip2",
    "SnappyCodec": "snappy",
}


def write_parquet(df: DataFrame, path: str) -> None:
    """Save as Parquet; fails if the path exists."""
    df.write.mode("errorifexists").parquet(path)


def codec_name(codec: str) -> str:
    name = CODECS.get(codec, codec)
    if name not in CODECS.values():
        raise ValueError(f"unknown codec {codec!r}; use one of {sorted(CODECS)}")
    return name


def write_json(
    df: DataFrame, path: str, codec: str | None = None, partitions: int = 0
) -> None:
    """Save as JSON lines; null fields are left out.

    Fails if the path exists. ``partitions`` is the number of files, 0 for one
    per task; there are more where one would get too many rows for a task, see
    ``repartition_rows``.
    """
    writer_codec = codec_name(codec) if codec else "none"
    df = repartition_rows(df, partitions)
    df.write.mode("errorifexists").option("compression", writer_codec).json(path)


_folders: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, in the cluster's shared one.

    ``spark.checkpoint.dir`` names it. Where that is unset, a local session
    writes beside its warehouse, and a cluster must name one that all executors
    reach. All such folders of an application are deleted when it ends.
    """
    context = spark.sparkContext
    if context.applicationId not in _folders:
        shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not shared:
            if not context.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            shared = spark.conf.get("spark.sql.warehouse.dir")
        folder = f"{shared.rstrip('/')}/whosaid-{context.applicationId}"
        jvm = context._jvm
        where = jvm.org.apache.hadoop.fs.Path(folder)
        files = where.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
        _folders[context.applicationId] = folder
    return f"{_folders[context.applicationId]}/{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table once and read it back, to compute it once only.

    The copy survives the loss of executors, and its lineage is one scan.
    """
    path = folder or work_folder(df.sparkSession)
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Run metrics: how many documents a job wrote, and how fast."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RunMetrics:
    """Counts the rows that pass through a job while it runs.

    >>> metrics = RunMetrics()
    >>> write_json(metrics.watch(entries), path)
    >>> metrics.report()

    It takes no second pass. Watch what is written: after the last shuffle a task
    that is run again counts once, while a stage ahead of a shuffle that is run
    again, as when an executor is lost, counts its rows twice. ``committed_rows``
    counts what was written, whatever was run again; give it to ``report``.
    """

    def __init__(self) -> None:
        self._observation = Observation()
        self._start = time.monotonic()

    def watch(self, df: DataFrame, **conditions: Column) -> DataFrame:
        """The same rows, counted, and also those that meet each condition."""
        counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
        return df.observe(
            self._observation, F.count(F.lit(1)).alias("documents"), *counts
        )

    def report(self, documents: int | None = None) -> dict[str, float | int | None]:
        """Call after the action; waits for it if it still runs. ``documents`` is a
        count of what was written, to be used instead of the rows that passed."""
        counts = self._observation.get
        if documents is not None:
            counts = counts | {"documents": documents}
        documents = counts["documents"]
        seconds = time.monotonic() - self._start
        return {
            **counts,
            "seconds": seconds,
            "ms_per_document": seconds / documents * 1000 if documents else None,
            "documents_per_second": documents / seconds if documents else None,
        }


def committed_files(spark: SparkSession, path: str, form: str) -> DataFrame:
    """Rows (file, documents) for the files that a finished job left at a path.

    Only files of committed tasks are there, each once, however often stages were
    run again. Parquet files (form "parquet") give their numbers from their footers,
    JSON files (form "json") are read as lines, which are never parsed. A file
    without rows is not listed.
    """
    if form not in ("parquet", "json"):
        raise ValueError(f"form must be 'parquet' or 'json', not {form!r}")
    rows = spark.read.parquet(path) if form == "parquet" else spark.read.text(path)
    file = F.col("_metadata.file_name").alias("file")
    return rows.groupBy(file).agg(F.count(F.lit(1)).alias("documents"))


def committed_rows(spark: SparkSession, path: str, form: str) -> int:
    """The number of rows that a finished job left at a path."""
    total = committed_files(spark, path, form).agg(F.sum("documents")).first()[0]
    return total or 0

"""Members of tar.gz archives as rows."""

from __future__ import annotations

import io
import re
import sys
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from whosaid.schemas import RAW

# Workers get these helpers with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBER = StructType(
    [
        StructField("path", StringType()),
        StructField("member", StringType()),
        StructField("data", BinaryType()),
    ]
)

#: A batch of members is handed on at this size.
BATCH_BYTES = 8 * 2**20
BATCH_MEMBERS = 1_000


def _whole_lines(file) -> Iterator[bytes]:
    """A file in pieces of whole lines, so that its size does not matter."""
    rest: list[bytes] = []
    while block := file.read(BATCH_BYTES):
        cut = block.rfind(b"\n") + 1
        rest.append(block[:cut] if cut else block)
        if cut:
            yield b"".join(rest)
            rest = [block[cut:]]
    if any(rest):
        yield b"".join(rest)


def _members(path: str, stream, lines: bool) -> Iterator[tuple[str, str, bytes]]:
    """The files of one archive, read front to back, one in memory at a time."""
    with tarfile.open(fileobj=stream, mode="r|gz") as archive:
        for member in archive:
            if member.isfile():
                file = archive.extractfile(member)
                for data in _whole_lines(file) if lines else (file.read(),):
                    yield path, member.name, data


def _batches(rows: Iterator[tuple[str, str, bytes]]) -> Iterator[pd.DataFrame]:
    batch, size = [], 0
    for row in rows:
        batch.append(row)
        size += len(row[2])
        if size >= BATCH_BYTES or len(batch) >= BATCH_MEMBERS:
            yield pd.DataFrame(batch, columns=MEMBER.names)
            batch, size = [], 0
    if batch:
        yield pd.DataFrame(batch, columns=MEMBER.names)


def _open(path: str):
    # Arrow wants three slashes where Hadoop writes one, and names S3 plainly.
    uri = re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "file:///", path))
    filesystem, name = FileSystem.from_uri(uri)
    return filesystem.open_input_stream(name, compression=None)


def _unpack(frames: Iterator[pd.DataFrame], lines: bool) -> Iterator[pd.DataFrame]:
    """Rows ``(path, content)``, or ``(path)`` to be opened here."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            is_read = hasattr(row, "content")
            with io.BytesIO(row.content) if is_read else _open(row.path) as stream:
                yield from _batches(_members(row.path, stream, lines))


def unpack_archives(archives: DataFrame, lines: bool = False) -> DataFrame:
    """Rows ``(path, content)``, or only ``(path)``, to one row per member file.

    Folders and links are left out. A corrupt archive fails the job. With
    ``lines`` a member comes as one or more rows of whole lines each, which puts
    no limit on its size.
    """

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _unpack(frames, lines)

    return archives.mapInPandas(unpack, MEMBER)


def scan_archives(
    spark: SparkSession, glob: str, stream: bool = True, lines: bool = False
) -> DataFrame:
    """Every file in every archive as ``(path, member, data)``.

    An archive is one task, which reads it piece by piece, of any size, from
    file systems that Arrow can open. Without ``stream`` Spark reads it whole,
    from any it knows, which its binary source allows up to 2 GB.
    """
    archives = spark.read.format("binaryFile").load(glob)
    columns = ["path"] if stream else ["path", "content"]
    return unpack_archives(archives.select(columns), lines)


def decode_records(members: DataFrame, partitions: int = 0) -> DataFrame:
    """Members that hold JSON lines, as records of schema RAW.

    ``partitions`` spreads the lines, for archives that are few and large. A
    line that is no record fails the job.
    """
    lines = members.select(
        F.explode(F.split(F.decode("data", "UTF-8"), "\n")).alias("line")
    ).where(F.trim("line") != "")
    if partitions > 0:
        lines = lines.repartition(partitions)
    record = F.from_json("line", RAW, {"mode": "FAILFAST"})
    return lines.select(record.alias("record")).select("record.*")

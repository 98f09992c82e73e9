"""Operator 4: document fingerprints of content-defined chunks."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a chunk: the least, the aim and the most.
SMALLEST, NORMAL, LARGEST = 16, 48, 192
#: Bits that must be clear at a boundary, below and above the aim.
STRICT_BITS, LOOSE_BITS = 6, 4
#: Bytes hashed at once.
PIECE = 1 << 20
#: Rows aimed at in a range of neighbours.
RANGE_ROWS = 5_000

_GEAR = np.array(
    [xxhash.xxh32_intdigest(bytes([b]), seed=4) for b in range(256)], dtype=np.uint32
)
_WINDOW = 32


def _gear(buf: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: the sum of the last 32 bytes' numbers, each
    doubled once for every byte after it."""
    h = _GEAR[buf]
    for width in (1, 2, 4, 8, 16):
        step = h.copy()
        step[width:] += h[:-width] << np.uint32(width)
        h = step
    return h


def _marks(text: bytes) -> tuple[list[int], list[int]]:
    """Ends of possible chunks, by the strict and by the loose rule."""
    strict, loose = [], []
    for start in range(0, len(text), PIECE):
        lead = min(start, _WINDOW)
        buf = np.frombuffer(text[start - lead : start + PIECE], np.uint8)
        h = _gear(buf)[lead:]
        at = np.flatnonzero(h >> np.uint32(32 - LOOSE_BITS) == 0)
        ends = at + (start + 1)
        loose.extend(ends.tolist())
        strict.extend(ends[h[at] >> np.uint32(32 - STRICT_BITS) == 0].tolist())
    return strict, loose


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of a text end.

    A chunk ends at the first mark by the strict rule between the least size and
    the aim, else at the first by the loose rule up to the most, else there.
    Marks depend on the 32 bytes before them, so that chunks find their old
    boundaries again after an insertion.
    """
    strict, loose = _marks(text)
    ends, start, n = [], 0, len(text)
    while n - start > SMALLEST:
        i = bisect_left(strict, start + SMALLEST)
        if i < len(strict) and strict[i] < start + NORMAL:
            end = strict[i]
        else:
            i = bisect_left(loose, start + NORMAL)
            end = start + LARGEST
            if i < len(loose) and loose[i] < end:
                end = loose[i]
        end = min(end, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def fingerprint(text: bytes) -> dict[str, int]:
    """The chunks of a whole text: digest to length; a repeated chunk counts once."""
    out, start = {}, 0
    for end in chunk_ends(text):
        out[f"{xxhash.xxh64_intdigest(text[start:end]):016x}"] = end - start
        start = end
    return out


def spelled(chunks: dict[str, int]) -> str:
    """A fingerprint as text: sorted digests, each with its length."""
    return " ".join(f"{d}:{n}" for d, n in sorted(chunks.items()))


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """The share of a's bytes in chunks that b has too; of two texts without
    bytes one, of a text without bytes in another zero."""
    if not a or not b:
        return float(not a and not b)
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_ranges(docs: DataFrame, range_rows: int) -> DataFrame:
    """Rows (range, foreign, id, tie, doc_id, text): ranges of ascending doc_id,
    each with the rows that start the next one (the last: the first) as foreign.

    The ranges are those of Spark's range partitioning of the ids alone. The
    driver gets their first ids, one number a range.
    """
    lowest = -(1 << 63)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    ids = rows.select("id")
    count = max(1, -(-ids.count() // range_rows))
    firsts = (
        ids.repartitionByRange(count, "id")
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min("id").alias("first"))
        .collect()
    )
    starts = np.array(sorted(r["first"] for r in firsts) or [lowest], dtype=np.int64)

    @F.pandas_udf("long")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, ids.to_numpy(), side="right") - 1)

    @F.pandas_udf("boolean")
    def is_start(ids: pd.Series) -> pd.Series:
        return pd.Series(np.isin(ids.to_numpy(), starts))

    own = F.struct(F.col("own").alias("range"), F.lit(False).alias("foreign"))
    before = F.pmod(F.col("own") - 1, F.lit(len(starts)))
    ahead = F.struct(before.alias("range"), F.lit(True).alias("foreign"))
    places = F.when(F.col("starts"), F.array(own, ahead)).otherwise(F.array(own))
    return rows.withColumns({"own": range_of("id"), "starts": is_start("id")}).select(
        F.inline(places), "id", F.xxhash64("text").alias("tie"), "doc_id", "text"
    )


FINGERPRINTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows (doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next) for each row of (doc_id, text).

    A fingerprint is the set of a whole text's content-defined chunks; likeness
    is the containment of the row's fingerprint in the other, weighted by
    length. ``edited`` has the last half of the code points replaced by the
    start of the next document in ascending doc_id; after the last comes the
    first. Rows with one doc_id are in the order of their texts' hashes, rows
    without one come first. A null text counts as empty; a lone row follows
    itself; an empty table gives no rows.

    Texts move once, to the range of their id, where they are read in order, one
    row at a time.
    """
    ranges = in_ranges(docs, range_rows)
    ordered = ranges.repartition("range").sortWithinPartitions(
        "range", "foreign", "id", "tie", "text"
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out: dict[str, list] = {c: [] for c in FINGERPRINTS.names}
            columns = [batch.column(c).to_pylist() for c in ("range", "foreign", "doc_id", "text")]
            for number, foreign, doc_id, text in zip(*columns):
                if last is None and foreign:
                    continue  # more rows with the next range's first id
                chunks = fingerprint(text.encode())
                if last is not None:
                    _, own_id, own_text, own_chunks = last
                    changed = edited(own_text, text)
                    changed_chunks = fingerprint(changed.encode())
                    out["doc_id"].append(own_id)
                    out["n_chars"].append(len(own_text))
                    out["edited"].append(changed)
                    out["fingerprint"].append(spelled(own_chunks))
                    out["edited_fingerprint"].append(spelled(changed_chunks))
                    out["near_edited"].append(containment(own_chunks, changed_chunks))
                    out["near_next"].append(containment(own_chunks, chunks))
                last = None if foreign else (number, doc_id, text, chunks)
            yield pa.RecordBatch.from_pydict(out, schema=FINGERPRINTS)

    return ordered.select("range", "foreign", "doc_id", "text").mapInArrow(
        walk,
        "doc_id long, n_chars long, edited string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )

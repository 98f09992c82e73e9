"""Distinct texts in segments of bounded size, and keys that occur twice.

Several operators ask the same question of very many 64-bit keys per text:
which of them occur anywhere else? One row per key would cost some thirty bytes
in a shuffle. Here a segment (the texts with one hash residue) sorts its keys
once and sends each bucket of the key space one packed, delta-coded run of
them, about six bytes a key. The bucket answers with one bit a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEXTS = pa.schema(
    [("seg", pa.int32()), ("text", pa.binary()), ("ids", pa.list_(pa.int64()))]
)
RUNS = pa.schema(
    [("bucket", pa.int32()), ("seg", pa.int32()), ("n", pa.int64()), ("run", pa.binary())]
)
BITS = pa.schema(
    [("seg", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("bits", pa.binary())]
)

OWNED = pa.schema(
    [
        ("bucket", pa.int32()),
        ("chunk", pa.int64()),
        ("n", pa.int64()),
        ("run", pa.binary()),
        ("owners", pa.binary()),
        ("keys", pa.binary()),
    ]
)
LONELY = pa.schema([("chunk", pa.int64()), ("keys", pa.binary()), ("own", pa.binary())])

Keys = tuple[np.ndarray, np.ndarray]


def segments(docs: DataFrame, segment_bytes: int) -> tuple[DataFrame, int]:
    """Rows (seg, text, ids), and the number of segments.

    ``docs`` has doc_id and text; a null text counts as empty. Copies within a
    batch become one row before the shuffle, so that even a text that a third
    of all rows share moves once per batch. All copies meet in one segment.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // segment_bytes))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, list] = {}
            for doc_id, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ):
                seen.setdefault(text, []).append(doc_id)
            seg = [xxhash.xxh64_intdigest(t) % count for t in seen]
            yield pa.RecordBatch.from_pydict(
                {"seg": seg, "text": list(seen), "ids": list(seen.values())},
                schema=TEXTS,
            )

    return rows.mapInArrow(combine, "seg int, text binary, ids array<long>"), count


def merged(texts: pa.Table) -> dict[bytes, list]:
    """The distinct texts of a segment, each with the ids of all its rows."""
    out: dict[bytes, list] = {}
    for text, ids in zip(texts["text"].to_pylist(), texts["ids"].to_pylist()):
        out.setdefault(text, []).extend(ids)
    return out


def pack(run: np.ndarray) -> bytes:
    """Sorted keys as byte planes of their differences; high planes are zeros."""
    return np.diff(run, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(run: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(run, np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's share of the sorted keys starts, and the end."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def runs(seg: int, keys: np.ndarray, buckets: int) -> pa.Table:
    """A segment's sorted, distinct keys, dealt to buckets."""
    at = cuts(keys, buckets)
    full = np.flatnonzero(np.diff(at))
    return pa.table(
        {
            "bucket": full,
            "seg": np.full(len(full), seg),
            "n": np.diff(at)[full],
            "run": [pack(keys[at[b] : at[b + 1]]) for b in full],
        }
    ).cast(RUNS)


def shared_bits(sent: DataFrame) -> DataFrame:
    """For each run, one bit a key: does another segment have it?"""

    def answer(bucket: pa.Table) -> pa.Table:
        counts = bucket["n"].to_pylist()
        parts = [unpack(r, n) for r, n in zip(bucket["run"].to_pylist(), counts)]
        keys = np.sort(np.concatenate(parts))
        twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
        bits = [np.packbits(found(part, twice)).tobytes() for part in parts]
        return pa.table(
            {"seg": bucket["seg"], "bucket": bucket["bucket"], "n": counts, "bits": bits}
        ).cast(BITS)

    return sent.groupBy("bucket").applyInArrow(
        answer, "seg int, bucket int, n long, bits binary"
    )


def found(keys: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted list."""
    if not len(listed):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(listed, keys)
    at[at == len(listed)] = 0
    return listed[at] == keys


def flags(answers: pa.Table) -> np.ndarray:
    """A segment's answers in the order of its sorted keys."""
    rows = sorted(zip(*(answers[c].to_pylist() for c in ("bucket", "n", "bits"))))
    parts = [
        np.unpackbits(np.frombuffer(bits, np.uint8), count=n) for _, n, bits in rows
    ]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def repeated_keys(
    texts: DataFrame, keys_of: Callable[[pa.Table], np.ndarray], buckets: int
) -> DataFrame:
    """Rows (seg, bucket, n, bits) for the keys of each segment of texts.

    ``keys_of`` gives a segment's sorted, distinct keys, whatever the order of
    its rows: a task that is run again sends the same run.
    """

    def send(seg: tuple, segment: pa.Table) -> pa.Table:
        return runs(seg[0].as_py(), keys_of(segment), buckets)

    sent = texts.groupBy("seg").applyInArrow(
        send, "bucket int, seg int, n long, run binary"
    )
    return shared_bits(sent)


def _owned_runs(sets: list[tuple[int, np.ndarray]], buckets: int) -> pa.RecordBatch:
    """The elements of some sets (key, elements), dealt to buckets: per bucket a sorted
    run, the place of each element's owner among the keys of this run's owners, and
    these keys."""
    keys = np.array([key for key, _ in sets], np.int64)
    elements = np.concatenate([s for _, s in sets])
    owners = np.repeat(np.arange(len(sets)), [len(s) for _, s in sets])
    order = np.argsort(elements, kind="stable")
    elements, owners = elements[order], owners[order]
    at = cuts(elements, buckets)
    rows = []
    for b in np.flatnonzero(np.diff(at)).tolist():
        part = slice(at[b], at[b + 1])
        present, places = np.unique(owners[part], return_inverse=True)
        rows.append(
            {
                "bucket": b,
                "chunk": int(keys[0]),
                "n": int(at[b + 1] - at[b]),
                "run": pack(elements[part]),
                "owners": places.astype(np.uint16).tobytes(),
                "keys": keys[present].tobytes(),
            }
        )
    return pa.RecordBatch.from_pylist(rows, schema=OWNED)


def unshared(sets: DataFrame, segment_bytes: int) -> DataFrame:
    """Rows (key, own) for rows (key, size, elements) of sets of 64-bit hashes: how many
    elements of a set no other row has. Sets without such elements may be left out.

    Chunks of sets send each bucket of the key space one run, and the bucket gives
    each chunk one count for each of its sets.
    """
    total = sets.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-8 * total // segment_bytes))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[tuple[int, np.ndarray]] = []
        size = 0
        for batch in batches:
            for key, elements in zip(batch.column(0), batch.column(1)):
                chunk.append((key.as_py(), np.frombuffer(elements.as_py(), np.uint64)))
                size += chunk[-1][1].nbytes
                if size >= segment_bytes or len(chunk) == 1 << 16:
                    yield _owned_runs(chunk, buckets)
                    chunk, size = [], 0
        if chunk:
            yield _owned_runs(chunk, buckets)

    def answer(bucket: pa.Table) -> pa.Table:
        runs_ = zip(bucket["run"].to_pylist(), bucket["n"].to_pylist())
        parts = [unpack(r, n) for r, n in runs_]
        keys = np.sort(np.concatenate(parts))
        twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
        own = [
            np.bincount(np.frombuffer(o, np.uint16)[~found(part, twice)], minlength=len(k) // 8)
            for part, o, k in zip(parts, bucket["owners"].to_pylist(), bucket["keys"].to_pylist())
        ]
        return pa.table(
            {
                "chunk": bucket["chunk"],
                "keys": bucket["keys"],
                "own": [o.astype(np.int64).tobytes() for o in own],
            }
        ).cast(LONELY)

    def summed(chunk: pa.Table) -> pa.Table:
        keys, own = (
            np.frombuffer(b"".join(chunk[c].to_pylist()), np.int64) for c in ("keys", "own")
        )
        keys, places = np.unique(keys, return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, places, own)
        return pa.table({"key": keys, "own": sums})

    sent = sets.select("key", "elements").mapInArrow(
        send, "bucket int, chunk long, n long, run binary, owners binary, keys binary"
    )
    counted = sent.groupBy("bucket").applyInArrow(answer, "chunk long, keys binary, own binary")
    return counted.groupBy("chunk").applyInArrow(summed, "key long, own long")

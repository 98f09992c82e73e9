"""Operator 13: repeated word passages, found by fixed reference blocks and extended.

Every text is cut into non-overlapping blocks of words, the index. Every rolling
window of a block's length, in every text, probes it. What stands around a hit is
then extended, word by word, to maximal exact repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from whosaid.llm.jaccard_join import mix, word_hashes
from whosaid.llm.segments import found, pack, unpack
from whosaid.llm.tables import stored
from whosaid.operators.skew import spread_join

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
#: Bits of a key of the index; equal keys only nominate, words decide.
KEY_BITS = 48

TEXTS = "seg int, digest binary, text binary, copies long"
PROBES = "bucket int, seg int, n long, run binary, marks binary"
ANSWERS = "seg int, bucket int, n long, marks binary"
SNIPPETS = "bucket int, seg int, words binary, places binary, text_no binary, start binary"
REPEATS = "seg int, text_no binary, start binary, mask binary"
RESULTS = "digest binary, n_words long, spans array<struct<start:long,end:long>>, kept binary"


def distinct_texts(docs: DataFrame, segment_bytes: int) -> tuple[DataFrame, int]:
    """Rows (seg, digest, text, copies), and the bytes of all texts.

    No ids: rows find their text again by its SHA-256. Copies within a batch are
    one row before the shuffle; those of a text meet in one segment.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    count = max(1, -(-total // segment_bytes))
    digest = F.unhex(F.sha2(text, 256))
    rows = docs.select(
        F.pmod(F.xxhash64(digest), F.lit(count)).cast("int").alias("seg"),
        digest.alias("digest"),
        text.cast("binary").alias("text"),
    )

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grouped = pa.Table.from_batches([batch]).group_by("digest", use_threads=False)
            first = grouped.aggregate([("seg", "min"), ("seg", "count"), ([], "count_all")])
            at = pc.index_in(first["digest"], batch.column("digest"))
            out = pa.table(
                {
                    "seg": first["seg_min"],
                    "digest": first["digest"],
                    "text": batch.column("text").take(at.combine_chunks()),
                    "copies": first["seg_count"],
                }
            )
            yield from out.to_batches()

    return rows.mapInArrow(combine, TEXTS), total


def _merged(segment: pa.Table) -> tuple[list[bytes], list[bytes], list[int]]:
    """The distinct texts of a segment by digest, their digests and copies."""
    seen: dict[bytes, list] = {}
    for digest, text, n in zip(*(segment[c].to_pylist() for c in ("digest", "text", "copies"))):
        row = seen.setdefault(digest, [text, 0])
        row[1] += n
    digests = sorted(seen)
    return digests, [seen[d][0] for d in digests], [seen[d][1] for d in digests]


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` numbers."""
    n = len(h)
    if n < size:
        return np.zeros(0, U)

    def powers(base: int) -> np.ndarray:
        row = np.full(n + 1, U(base))
        row[0] = 1
        return np.cumprod(row, dtype=U)

    prefix = np.zeros(n + 1, U)
    np.cumsum(h * powers(_BASE)[:n], dtype=U, out=prefix[1:])
    inverse = powers(pow(_BASE, -1, 1 << 64))
    return mix((prefix[size:] - prefix[:-size]) * inverse[: n - size + 1])


class Probes:
    """All rolling windows of the texts of a segment that are long enough."""

    def __init__(self, texts: list[bytes], block: int, bits: int) -> None:
        h, counts = word_hashes(texts)
        ends = np.cumsum(counts)
        keys = grams(h, block) >> U(64 - bits)
        owner = np.repeat(np.arange(len(texts)), counts)[: len(keys)]
        place = np.arange(len(keys)) - (ends - counts)[owner]
        inside = place + block <= counts[owner]
        self.keys, self.owner, self.place = keys[inside], owner[inside], place[inside]
        self.counts = counts

    def listed(self, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys; whether one is a reference block, and occurs twice."""
        keys, times = np.unique(self.keys, return_counts=True)
        blocks = np.unique(self.keys[self.place % block == 0])
        return keys, found(keys, blocks), times > 1


def _edges(buckets: int, bits: int) -> np.ndarray:
    return np.array([-(-(b << bits) // buckets) for b in range(buckets)], dtype=U)


def _bits(*marks: np.ndarray) -> bytes:
    return b"".join(np.packbits(m).tobytes() for m in marks)


def _unbits(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = -(-n // 8)
    raw = np.frombuffer(data, np.uint8)
    return tuple(np.unpackbits(raw[i * size :][:size], count=n).astype(bool) for i in (0, 1))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def matched(bucket: pa.Table, hot_segments: int) -> pa.Table:
    """Per key of each run: does it occur twice, once of them as a reference block,
    and do many segments have it?"""
    counts = bucket["n"].to_pylist()
    parts = [unpack(r, n) for r, n in zip(bucket["run"].to_pylist(), counts)]
    marks = [_unbits(m, n) for m, n in zip(bucket["marks"].to_pylist(), counts)]
    keys, where = np.unique(np.concatenate(parts), return_inverse=True)
    blocks = np.bincount(where, np.concatenate([m[0] for m in marks]), len(keys)) > 0
    segments = np.bincount(where, minlength=len(keys))
    times = segments + np.bincount(where, np.concatenate([m[1] for m in marks]), len(keys))
    hit, hot = (blocks & (times > 1))[where], (segments >= hot_segments)[where]
    ends = np.cumsum(counts)
    return pa.table(
        {
            "seg": bucket["seg"],
            "bucket": bucket["bucket"],
            "n": counts,
            "marks": [_bits(hit[e - n : e], hot[e - n : e]) for n, e in zip(counts, ends)],
        }
    ).cast(_schema(ANSWERS))


def _answered(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A segment's answers in the order of its sorted keys."""
    rows = sorted(zip(*(answers[c].to_pylist() for c in ("bucket", "n", "marks"))))
    parts = [_unbits(marks, n) for _, n, marks in rows]
    if not parts:
        return np.zeros(0, bool), np.zeros(0, bool)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _windows(
    ids: np.ndarray, begin: np.ndarray, sizes: np.ndarray, window: int, bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash, the start and the snippet of each window, some snippets at a time."""
    keys, at, own = [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, len(sizes), 1 << 13):
        some = slice(low, low + (1 << 13))
        base, count = begin[some][0], sizes[some]
        owner = np.repeat(np.arange(len(count)), count)
        hashed = grams(mix(ids[base : base + len(owner)].astype(U) + U(1)), window)
        starts = np.arange(len(hashed))
        ends = begin[some] - base + count
        starts = starts[starts + window <= ends[owner[: len(hashed)]]]
        keys.append(hashed[starts] >> U(64 - bits))
        at.append(starts + base)
        own.append(owner[starts] + low)
    return np.concatenate(keys), np.concatenate(at), np.concatenate(own)


def extended(bucket: pa.Table, window: int, bits: int) -> pa.Table:
    """The windows of some snippets that stand at two places, by their words.

    Hashes bring equal windows together; each is then compared, word by word, to
    the first of its class, and a class with different words is split by them.
    """
    rows = bucket.select(["seg", "words", "places", "text_no", "start"]).to_pylist()
    compressed = pa.Codec("zstd")
    snippets: list[bytes] = []
    seg, times = [], []
    text_no, start = [], []
    for row in rows:
        size = int.from_bytes(row["words"][:8], "little")
        lines = compressed.decompress(row["words"][8:], size).to_pybytes().split(b"\n")
        snippets += lines
        times.append(np.frombuffer(row["places"], np.int32))
        seg.append(np.full(len(lines), row["seg"]))
        text_no.append(np.frombuffer(row["text_no"], np.int32))
        start.append(np.frombuffer(row["start"], np.int32))
    times, seg = np.concatenate(times), np.concatenate(seg)
    text_no, start = np.concatenate(text_no), np.concatenate(start)
    first = np.cumsum(times) - times

    words = pc.split_pattern(pa.array(snippets, pa.large_binary()), b" ")
    sizes = np.diff(words.offsets.to_numpy())
    ids = words.flatten().dictionary_encode().indices.to_numpy().astype(np.int32)
    del words, snippets
    begin = np.cumsum(sizes) - sizes
    keys, at, own = _windows(ids, begin, sizes, window, bits)

    order = np.argsort(keys, kind="stable")
    keys, at, own = keys[order], at[order], own[order]
    del order
    new = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(at)]
    del keys
    group = np.cumsum(new) - 1
    same = np.ones(len(at), bool)
    leader = at[new][group] if len(at) else at
    for i in range(window):
        same &= ids[at + i] == ids[leader + i]
    if not same.all():
        exact: dict[tuple, int] = {}
        group = np.array(
            [
                exact.setdefault((g, ids[a : a + window].tobytes()), len(exact))
                for g, a in zip(group.tolist(), at.tolist())
            ]
        )
    lead = np.zeros(group.max() + 1 if len(group) else 0, np.int64)
    lead[group[::-1]] = np.arange(len(at))[::-1]
    other = times[own] > 1
    offset = at - begin[own]
    for place in (seg[own], text_no[first[own]], start[first[own]] + offset):
        other |= place != place[lead[group]]
    twice = np.bincount(group, other, len(lead)) > 0
    mask = np.zeros(len(sizes), np.int64)
    np.bitwise_or.at(mask, own, twice[group].astype(np.int64) << offset)

    all_masks = np.repeat(mask, times)
    all_segs = np.repeat(seg, times)
    out: dict[str, list] = {c: [] for c in ("seg", "text_no", "start", "mask")}
    for s in np.unique(seg).tolist():
        mine = (all_segs == s) & (all_masks != 0)
        if mine.any():
            out["seg"].append(s)
            out["text_no"].append(text_no[mine].tobytes())
            out["start"].append(start[mine].tobytes())
            out["mask"].append(all_masks[mine].tobytes())
    return pa.table(out, schema=_schema(REPEATS))


def _covered(answers: pa.Table, counts: np.ndarray, window: int) -> np.ndarray:
    """Which of a segment's words are in a repeated window."""
    begin = np.cumsum(counts) - counts
    depth = np.zeros(counts.sum() + 1, np.int64)
    for row in answers.select(["text_no", "start", "mask"]).to_pylist():
        text_no, start = (np.frombuffer(row[c], np.int32) for c in ("text_no", "start"))
        mask = np.frombuffer(row["mask"], np.int64)
        first = begin[text_no] + start
        for offset in range(int(mask.max()).bit_length()):
            at = first[(mask >> offset) & 1 == 1] + offset
            np.add.at(depth, at, 1)
            np.add.at(depth, at + window, -1)
    return np.cumsum(depth)[:-1] > 0


def _spans(covered: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]])))
    return [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]


def repeated_passages(
    docs: DataFrame,
    window: int = 35,
    segment_bytes: int = 8 << 20,
    bucket_bytes: int = 16 << 20,
    hot_segments: int = 1000,
    key_bits: int = KEY_BITS,
) -> DataFrame:
    """Rows (digest, n_words, spans, kept) for each distinct text of (text).

    A word is removed if a window of ``window`` words that covers it also starts
    anywhere else, in the same text or another; windows do not cross texts, and
    words are what ASCII white space separates. spans are the maximal removed runs
    of words, kept the other words joined by one space, digest the SHA-256 of the
    text (see ``with_rows``).

    A window holds a whole reference block, one of half its length, of each text
    that has it. So a repeat is found where a rolling window of that text or
    another equals the block: keys of all rolling windows go, as sorted runs, to
    buckets of the key space, and a bit each comes back. Around each hit the words
    that a window with this block can reach go to the bucket of the key once more,
    and are compared there. The keys only nominate: equal words decide, whatever
    ``key_bits`` are. A key that at least ``hot_segments`` segments have is dealt
    by its whole windows, each once a segment, so that no task gets all texts
    around a common passage.

    A null text and one without words keep nothing and have no words. Texts of fewer
    words than a window keep everything. Repeated rows are repeats of each other.
    An empty table gives no rows; no column but text is read.
    """
    if not 2 <= window <= 64:
        raise ValueError("window must be from 2 to 64 words")
    block = (window + 1) // 2
    texts, total = distinct_texts(docs, segment_bytes)
    buckets = max(1, -(-total // bucket_bytes))
    edges = _edges(buckets, key_bits)
    grouped = texts.groupBy("seg")

    def long_texts(segment: pa.Table) -> list[bytes]:
        return [t if t.count(b" ") or len(t) > window else b"" for t in _merged(segment)[1]]

    def send(seg: tuple, segment: pa.Table) -> pa.Table:
        keys, blocks, twice = Probes(long_texts(segment), block, key_bits).listed(block)
        at = np.append(np.searchsorted(keys, edges), len(keys))
        full = np.flatnonzero(np.diff(at))
        cuts = [slice(at[b], at[b + 1]) for b in full]
        return pa.table(
            {
                "bucket": full,
                "seg": np.full(len(full), seg[0].as_py()),
                "n": np.diff(at)[full],
                "run": [pack(keys[c]) for c in cuts],
                "marks": [_bits(blocks[c], twice[c]) for c in cuts],
            }
        ).cast(_schema(PROBES))

    answers = (
        grouped.applyInArrow(send, PROBES)
        .groupBy("bucket")
        .applyInArrow(lambda bucket: matched(bucket, hot_segments), ANSWERS)
    )

    def reach(seg: tuple, segment: pa.Table, answer: pa.Table) -> pa.Table:
        all_texts = long_texts(segment)
        probes = Probes(all_texts, block, key_bits)
        keys = np.unique(probes.keys)
        hit, hot = _answered(answer)
        at = np.flatnonzero(found(probes.keys, keys[hit]))
        is_hot = found(probes.keys[at], keys[hit & hot])
        routes = np.searchsorted(edges, probes.keys[at], side="right") - 1
        sent: dict[int, dict[bytes, dict]] = {}
        last, words = -1, []
        rows = zip(probes.owner[at].tolist(), probes.place[at].tolist(), routes.tolist(), is_hot.tolist())
        for number, place, route, spread in rows:
            if number != last:
                last, words = number, all_texts[number].split()
            lo, hi = max(0, place + block - window), min(len(words), place + window)
            if hi - lo < window:
                continue
            if not spread:
                snippet = b" ".join(words[lo:hi])
                sent.setdefault(route, {}).setdefault(snippet, {})[number, lo] = None
                continue
            for a in range(lo, hi - window + 1):
                snippet = b" ".join(words[a : a + window])
                own = xxhash.xxh64_intdigest(snippet) % buckets
                sent.setdefault(own, {}).setdefault(snippet, {})[number, a] = None
        out: dict[str, list] = {c.split()[0]: [] for c in SNIPPETS.split(", ")}
        for bucket, snippets in sorted(sent.items()):
            joined = b"\n".join(snippets)
            places = np.array([p for found_ in snippets.values() for p in found_], np.int32)
            out["bucket"].append(bucket)
            out["seg"].append(seg[0].as_py())
            packed = pa.Codec("zstd").compress(joined).to_pybytes()
            out["words"].append(len(joined).to_bytes(8, "little") + packed)
            out["places"].append(np.array([len(p) for p in snippets.values()], np.int32).tobytes())
            out["text_no"].append(places[:, 0].tobytes())
            out["start"].append(places[:, 1].tobytes())
        return pa.table(out, schema=_schema(SNIPPETS))

    repeats = (
        grouped.cogroup(answers.groupBy("seg"))
        .applyInArrow(reach, SNIPPETS)
        .groupBy("bucket")
        .applyInArrow(lambda bucket: extended(bucket, window, key_bits), REPEATS)
    )

    def cut(segment: pa.Table, answer: pa.Table) -> pa.Table:
        digests, all_texts, copies = _merged(segment)
        split = [t.split() for t in all_texts]
        counts = np.array([len(w) for w in split], np.int64)
        covered = _covered(answer, counts, window)
        out: dict[str, list] = {c: [] for c in ("digest", "n_words", "spans", "kept")}
        begin = 0
        for digest, words, n in zip(digests, split, copies):
            own = covered[begin : begin + len(words)]
            begin += len(words)
            if n > 1 and len(words) >= window:
                own = np.ones(len(words), bool)
            kept = words if not own.any() else [w for w, c in zip(words, own.tolist()) if not c]
            out["digest"].append(digest)
            out["n_words"].append(len(words))
            out["spans"].append(_spans(own))
            out["kept"].append(b" ".join(kept))
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.table(
            out,
            schema=pa.schema(
                [
                    ("digest", pa.binary()),
                    ("n_words", pa.int64()),
                    ("spans", pa.list_(span)),
                    ("kept", pa.binary()),
                ]
            ),
        )

    return grouped.cogroup(repeats.groupBy("seg")).applyInArrow(cut, RESULTS)


def with_rows(docs: DataFrame, results: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """The results of texts, by digest, for each row's doc_id.

    Rows of one text, however many, are dealt to tasks of ``hot_rows`` rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("row_digest"))
    joined = spread_join(results, rows, "digest", "row_digest", hot_rows)
    return joined.select("doc_id", *[c for c in results.columns if c != "digest"])


def remove_passages(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, n_words, spans, kept) for each row of (doc_id, text); see
    ``repeated_passages``. Rows that repeat give repeated results."""
    return with_rows(docs, stored(repeated_passages(docs, **options)))

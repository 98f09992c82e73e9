"""Operator 3: repeated byte strings, by blockwise sorting over a difference cover."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from whosaid.llm.jaccard_join import mix
from whosaid.llm.segments import (
    flags,
    found,
    merged,
    repeated_keys,
    runs,
    segments,
    shared_bits,
)

#: A difference cover. Every difference modulo 73 is the
#: difference of two of these residues.
PERIOD = 73
COVER = (0, 1, 3, 7, 15, 31, 36, 54, 63)

#: Window starts that are worked on at once; longer texts are cut into pieces.
BLOCK = 1 << 20

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))

SPANS = "array<struct<start:long,end:long>>"


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 powers of the base and of its inverse; a task keeps those
    for one block."""
    if n > BLOCK * 2 or not _powers or len(_powers[0][0]) <= n:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(max(n, BLOCK + (1 << 12)) + 1, U(base))
            row[0] = 1
            made.append(np.cumprod(row, dtype=U))
        if n > BLOCK * 2:
            return made[0], made[1]
        _powers[0] = made[0], made[1]
    return _powers[0]


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers from each first to its last."""
    sizes = last - first + 1
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first - before, sizes)


class Pieces:
    """Some pieces of texts, end to end: (text number, offset, bytes, whether a
    further piece of the text follows).

    Only the prefix sums have an entry per byte; places are computed for the
    cover samples, and for window starts near those that are shared.
    """

    def __init__(self, parts: list[tuple[int, int, bytes, bool]], length: int) -> None:
        self.parts, self.length = parts, length
        buf = np.frombuffer(b"".join(p for _, _, p, _ in parts), np.uint8)
        self.sizes = np.array([len(p) for _, _, p, _ in parts])
        self.starts = np.cumsum(self.sizes) - self.sizes
        power, self.inverse = powers(len(buf))
        self.prefix = np.zeros(len(buf) + 1, U)
        np.cumsum(_BYTE[buf] * power[: len(buf)], dtype=U, out=self.prefix[1:])

    def fingerprints(self, at: np.ndarray, length: int) -> np.ndarray:
        return mix((self.prefix[at + length] - self.prefix[at]) * self.inverse[at])

    def sample(self, lookahead: bool) -> tuple[np.ndarray, np.ndarray]:
        """Where cover samples start, and the piece of each. With ``lookahead``
        also those that the next piece of the same text counts as its own."""
        depth = self.length - PERIOD + 1
        cover = np.array(COVER)
        at, pieces_ = [], []
        for number, (_, offset, part, more) in enumerate(self.parts):
            last = len(part) - depth
            if more and not lookahead:
                last = min(last, BLOCK - 1)
            shift = offset % PERIOD
            rounds = np.arange(0, last + shift + 1, PERIOD)
            places = (rounds[:, None] + cover).ravel() - shift
            places = places[(places >= 0) & (places <= last)]
            at.append(places + self.starts[number])
            pieces_.append(np.full(len(places), number))
        return np.concatenate(at), np.concatenate(pieces_)

    def sample_keys(self, at: np.ndarray) -> np.ndarray:
        return self.fingerprints(at, self.length - PERIOD + 1)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Window starts with a shared sample in their first bytes."""
        at, piece = self.sample(lookahead=True)
        hit = found(self.sample_keys(at), shared)
        hits, piece = at[hit], piece[hit]
        start, size = self.starts[piece], self.sizes[piece]
        first = np.maximum(hits - PERIOD + 1, start)
        last = np.minimum(hits, start + np.minimum(size - self.length, BLOCK - 1))
        first = np.maximum(first, np.concatenate([[0], np.maximum.accumulate(last)[:-1] + 1])[: len(last)])
        some = first <= last
        return _ranges(first[some], last[some])

    def piece_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1


def pieces(texts: list[bytes], length: int) -> Iterator[Pieces]:
    """All texts with a whole window, in pieces of about one block."""
    parts, size = [], 0
    for number, text in enumerate(texts):
        for offset in range(0, len(text) - length + 1, BLOCK):
            part = text[offset : offset + BLOCK + length - 1]
            if parts and size + len(part) > BLOCK + length:
                yield Pieces(parts, length)
                parts, size = [], 0
            more = offset + BLOCK < len(text) - length + 1
            parts.append((number, offset, part, more))
            size += len(part)
    if parts:
        yield Pieces(parts, length)


def _joined(arrays: Iterator[np.ndarray]) -> np.ndarray:
    parts = list(arrays)
    return np.concatenate(parts) if parts else np.zeros(0, U)


def _sample_keys(texts: list[bytes], length: int) -> np.ndarray:
    def keys(block: Pieces) -> np.ndarray:
        return block.sample_keys(block.sample(lookahead=False)[0])

    return _joined(map(keys, pieces(texts, length)))


def _shared(keys: np.ndarray, answer: np.ndarray, times: np.ndarray) -> np.ndarray:
    return keys[answer | (times > 1)] if len(keys) else keys


def spans_of(runs_: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted intervals, joined where they meet."""
    out: list[list[int]] = []
    for start, end in sorted(runs_):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def remove_repeats(
    docs: DataFrame, length: int = 200, segment_bytes: int = 4 << 20
) -> DataFrame:
    """Rows (doc_id, n_bytes, spans, kept) for each row of (doc_id, text).

    A byte is removed if a string of ``length`` bytes that covers it also starts
    anywhere else, in the same document or another; strings do not cross
    documents. spans are the maximal removed runs, kept the other bytes.

    Suffixes are compared to a depth of ``length`` bytes. Two equal windows have
    cover samples at the same place within their first ``PERIOD`` bytes, so a
    window whose samples occur nowhere else is settled by them; only the others
    become suffix rows. Those are dealt to buckets, sorted one bucket at a time
    by the fingerprint of their prefix, and ties are the repeats. Order between
    different prefixes is of no use here, so the fingerprint stands for it.

    All copies of a text are one row. A null text has no bytes. Texts shorter
    than ``length`` keep everything. Repeated rows give repeated results, and
    each is a repeat of the others. Fingerprints have 64 bits.
    """
    if length <= PERIOD:
        raise ValueError(f"length must be above {PERIOD}")
    texts, count = segments(docs, segment_bytes)
    grouped = texts.groupBy("seg")

    def sample_keys(segment: pa.Table) -> np.ndarray:
        return np.unique(_sample_keys(list(merged(segment)), length))

    samples = repeated_keys(texts, sample_keys, count)

    def shared_samples(all_texts: list[bytes], answer: pa.Table) -> np.ndarray:
        keys, times = np.unique(_sample_keys(all_texts, length), return_counts=True)
        return _shared(keys, flags(answer), times)

    def window_keys(all_texts: list[bytes], shared: np.ndarray) -> np.ndarray:
        return _joined(
            b.fingerprints(b.candidates(shared), length)
            for b in pieces(all_texts, length)
        )

    def send(seg: tuple, segment: pa.Table, answer: pa.Table) -> pa.Table:
        all_texts = list(merged(segment))
        shared = shared_samples(all_texts, answer)
        return runs(seg[0].as_py(), np.unique(window_keys(all_texts, shared)), count)

    sent = grouped.cogroup(samples.groupBy("seg")).applyInArrow(
        send, "bucket int, seg int, n long, run binary"
    )
    answers = samples.withColumn("step", F.lit(0)).union(
        shared_bits(sent).withColumn("step", F.lit(1))
    )

    def cut(segment: pa.Table, answer: pa.Table) -> pa.Table:
        all_texts = merged(segment)
        texts_ = list(all_texts)
        step = answer["step"].to_numpy()
        shared = shared_samples(texts_, answer.filter(pa.array(step == 0)))
        keys, times = np.unique(window_keys(texts_, shared), return_counts=True)
        repeated = _shared(keys, flags(answer.filter(pa.array(step == 1))), times)
        covered: dict[int, list[tuple[int, int]]] = {}
        for block in pieces(texts_, length):
            at = block.candidates(shared)
            at = at[found(block.fingerprints(at, length), repeated)]
            if not len(at):
                continue
            piece = block.piece_of(at)
            breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(piece) > 0))
            first = at[np.append(0, breaks + 1)]
            last = at[np.append(breaks, len(at) - 1)]
            owners = block.piece_of(first).tolist()
            for a, b, p in zip(first.tolist(), last.tolist(), owners):
                number, offset, *_ = block.parts[p]
                base = offset - int(block.starts[p])
                covered.setdefault(number, []).append((a + base, b + base + length))
        out: dict[str, list] = {c: [] for c in ("doc_id", "n_bytes", "spans", "kept")}
        for number, (text, ids) in enumerate(all_texts.items()):
            if len(ids) > 1 and len(text) >= length:
                spans = [(0, len(text))]
            else:
                spans = spans_of(covered.get(number, []))
            edges = [0, *(x for s in spans for x in s), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            for doc_id in ids:
                out["doc_id"].append(doc_id)
                out["n_bytes"].append(len(text))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
                out["kept"].append(kept)
        return pa.table(
            out,
            schema=pa.schema(
                [
                    ("doc_id", pa.int64()),
                    ("n_bytes", pa.int64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ("kept", pa.binary()),
                ]
            ),
        )

    return grouped.cogroup(answers.groupBy("seg")).applyInArrow(
        cut, f"doc_id long, n_bytes long, spans {SPANS}, kept binary"
    )

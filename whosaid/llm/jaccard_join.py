"""Operator 1: n-gram Jaccard join with PartEnum signatures."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from whosaid.llm.components import components
from whosaid.llm.segments import flags, found, merged, repeated_keys, segments, unshared
from whosaid.llm.tables import drop, stored

#: Longs of the parity sketch of a set.
SKETCH = 8

U = np.uint64
_MIX = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_STEP = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * _MIX[0]
    x = (x ^ (x >> U(27))) * _MIX[1]
    return x ^ (x >> U(31))


#: Texts are hashed in pieces of about this many bytes; a piece takes sixty times that.
PIECE = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_BLANK = re.compile(rb"[ \t-\r]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text, cut at white space where it is very long."""
    start = 0
    while len(text) - start > PIECE:
        blank = _BLANK.search(text, start + PIECE)
        if not blank:
            break
        yield text[start : blank.end()]
        start = blank.end()
    yield text[start:] if start else text


def _hashed(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of some pieces, and their number in each."""
    sizes = np.array([len(p) + 1 for p in pieces])
    buf = _LOWER[np.frombuffer(b"\n".join(pieces) + b"\n", np.uint8)]
    inside = np.concatenate([[False], ~_SPACE[buf]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    # The last byte is a space, so each word has an end.
    starts, ends = edges[::2], edges[1::2]
    power = np.full(len(buf) + 1, U(_BASE))
    power[0] = 1
    power = np.cumprod(power, dtype=U)
    prefix = np.zeros(len(buf) + 1, U)
    np.cumsum(_BYTE[buf] * power[:-1], dtype=U, out=prefix[1:])
    inverse = np.full(len(buf) + 1, U(pow(_BASE, -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.cumprod(inverse, dtype=U)
    words = mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(U))
    upto = np.searchsorted(starts, np.cumsum(sizes))
    return words, np.diff(upto, prepend=0)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of whole texts, and their number in each.

    A-Z are lower-cased and words are split at ASCII white space.
    """
    hashes, counts = [np.zeros(0, U)], np.zeros(len(texts), np.int64)
    batch: list[bytes] = []
    owners: list[int] = []

    def flush() -> None:
        words, n = _hashed(batch)
        hashes.append(words)
        np.add.at(counts, owners, n)
        batch.clear()
        owners.clear()

    size = 0
    for number, text in enumerate(texts):
        for piece in _pieces(text):
            batch.append(piece)
            owners.append(number)
            size += len(piece)
            if size >= PIECE:
                flush()
                size = 0
    if batch:
        flush()
    return np.concatenate(hashes), counts


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Per text, the sorted hashes of its distinct k-word shingles.

    Fewer than k words are one shingle; no words have none.
    """
    h, counts = word_hashes(texts)

    def joined(h: np.ndarray, size: int) -> np.ndarray:
        n = max(0, len(h) - size + 1)
        out = np.full(n, U(size))
        for i in range(size):
            out = mix(out * _STEP + h[i : n + i])
        return out

    whole = joined(h, k)
    ends = np.cumsum(counts)
    sets = []
    for start, end in zip((ends - counts).tolist(), ends.tolist()):
        if end - start >= k:
            s = np.sort(whole[start : end - k + 1])
            sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            sets.append(joined(h[start:end], end - start) if end > start else h[:0])
    return sets


def bands(size: int, percent: int) -> list[tuple[int, int, int]]:
    """The size bands (number, smallest and largest size) in which a set of this
    size looks for partners: its own and the next."""
    number, low = 0, 1
    while True:
        high = max(low, low * 100 // percent)
        if size <= high:
            break
        number, low = number + 1, high + 1
    after = high + 1
    return [(number, low, high), (number + 1, after, max(after, after * 100 // percent))]


def furthest(size_sum: int, percent: int) -> int:
    """The largest symmetric difference of two sets of this total size with
    100 * intersection >= percent * union."""
    return size_sum * (100 - percent) // (100 + percent)


@dataclass(frozen=True)
class Band:
    """How the sets of a band are signed: parts that may have signatures without
    elements, the edges of the cells, and what is mixed into the signature of each
    pair of a part's cells."""

    spare: int
    edges: np.ndarray
    marks: np.ndarray


def spare_parts(size: int, needed: int) -> int:
    """Parts beyond those that are needed, so that sets of this size seldom have
    more parts than that with an empty pair of cells.

    More parts forgive more, but have smaller cells: the number with the least
    chance is taken, or the first whose chance is below a thousandth.
    """
    best = (2.0, 1)
    for spare in range(1, 13 + needed // 6):
        parts = needed + spare
        empty = min(1.0, 3 * (1 - 2 / (3 * parts)) ** size)
        term = within = (1 - empty) ** parts
        for i in range(1, spare + 1):
            term *= (parts - i + 1) / i * (empty / (1 - empty) if empty < 1 else 0.0)
            within += term
        best = min(best, (1 - within, spare))
        if best[0] < 1e-3:
            break
    return best[1]


def band(number: int, low: int, high: int, percent: int) -> Band:
    d = furthest(2 * high, percent)
    tag = mix(np.array([number + 1], U) * _STEP)
    if d == 0:
        return Band(0, np.zeros(0, U), tag)
    needed = (d + 2) // 2
    spare = spare_parts(low, needed)
    cells = 3 * (needed + spare)
    edges = np.array([(c << 64) // cells for c in range(cells)], dtype=U)
    places = np.arange(1, cells + 1, dtype=U).reshape(-1, 3)
    return Band(spare, edges, mix(places * _STEP + tag))


def prefix(s: np.ndarray, percent: int, number: int) -> np.ndarray:
    """Keys, for a band, of a sorted set's first elements: sets that are similar
    enough have one of them in common, that of their first common element."""
    needed = -(-len(s) * percent // 100)
    return mix(mix(s[: len(s) - needed + 1]) + mix(np.array([~number & _ALL], U)))


_ALL = (1 << 64) - 1


def signatures(s: np.ndarray, percent: int, cache: dict) -> np.ndarray:
    """The PartEnum signatures of a set.

    Two sets of a band differ in at most d elements. The hash domain is cut
    into n = ceil((d + 1) / 2) parts and j more, so that the sets differ in at
    most one element in j + 1 parts; each part has three cells, and each pair of
    its cells is a signature. The cell with the odd element is outside one of
    them. Only signatures with elements are given: a set in which j parts or
    fewer have a pair without any shares another one. Sets with more such parts have
    the keys of their prefix, too. ``cache`` keeps the bands.
    """
    if len(s) not in cache:
        cache[len(s)] = bands(len(s), percent)
    mixed = mix(s)
    total = np.concatenate([s[:0], [U(0)], np.cumsum(mixed, dtype=U)])
    out = []
    for number, low, high in cache[len(s)]:
        key = ("band", number)
        if key not in cache:
            cache[key] = band(number, low, high, percent)
        b = cache[key]
        if not b.spare:
            out.append(mix(b.marks + total[-1]))
            continue
        at = np.append(np.searchsorted(s, b.edges), len(s))
        sums = np.diff(total[at]).reshape(-1, 3)
        counts = np.diff(at).reshape(-1, 3)
        signed = mix(sums.sum(axis=1, keepdims=True, dtype=U) - sums + b.marks)
        full = counts.sum(axis=1, keepdims=True) > counts
        out.append(signed[full])
        if (~full.all(axis=1)).sum() > b.spare:
            out.append(prefix(s, percent, number))
    return np.concatenate(out)


def sketch(s: np.ndarray) -> list[int]:
    """Parity of the number of elements in each of 512 parts of the domain.

    Two sets' sketches differ in no more bits than the sets in elements.
    """
    bits = np.bincount((mix(s) >> U(64 - 9)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


def wide_sketch(s: np.ndarray) -> bytes:
    """Parity of the number of elements in each part of the domain, with four
    parts or more per element."""
    parts = 1 << max(9, (4 * len(s) - 1).bit_length())
    at = (mix(s) & U(parts - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=parts) & 1).astype(np.uint8)).tobytes()


def sketch_distance(x: bytes, y: bytes) -> int:
    """The bits in which two wide sketches differ; the wider one is folded."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def prepared(docs: DataFrame, k: int, percent: int, segment_bytes: int) -> DataFrame:
    """One stored row per distinct text: key (a hash of it), node (its smallest
    doc_id), the ids of its rows, the size of its set, and, if a signature of it
    occurs elsewhere, the set, its two sketches and those signatures."""
    texts, count = segments(docs, segment_bytes)

    def signed(segment: pa.Table) -> Iterator[tuple[bytes, list, np.ndarray, np.ndarray]]:
        cache: dict = {}
        texts_ = merged(segment)
        for (text, ids), s in zip(texts_.items(), shingle_sets(list(texts_), k)):
            yield text, ids, s, signatures(s, percent, cache) if len(s) else s

    def keys_of(segment: pa.Table) -> np.ndarray:
        return np.unique(np.concatenate([sig for *_, sig in signed(segment)]))

    answers = repeated_keys(texts, keys_of, count)

    def keep(segment: pa.Table, answer: pa.Table) -> pa.Table:
        all_signed = list(signed(segment))
        keys, times = np.unique(
            np.concatenate([sig for *_, sig in all_signed]), return_counts=True
        )
        shared = keys[flags(answer) | (times > 1)] if len(keys) else keys
        rows = []
        for text, ids, s, sig in all_signed:
            sig = sig[found(sig, shared)]
            known = [i for i in ids if i is not None]
            rows.append(
                {
                    "key": xxhash.xxh64_intdigest(text, seed=1) - (1 << 63),
                    "node": min(known) if known else None,
                    "ids": ids,
                    "size": len(s),
                    "sketch": sketch(s) if len(sig) else None,
                    "sigs": sig.view(np.int64).tolist() if known else [],
                    "wide": wide_sketch(s) if len(sig) and known else None,
                    "elements": s.tobytes() if len(sig) and known else None,
                }
            )
        return pa.Table.from_pylist(
            rows,
            schema=pa.schema(
                [
                    ("key", pa.int64()),
                    ("node", pa.int64()),
                    ("ids", pa.list_(pa.int64())),
                    ("size", pa.int64()),
                    ("sketch", pa.list_(pa.int64())),
                    ("sigs", pa.list_(pa.int64())),
                    ("wide", pa.binary()),
                    ("elements", pa.binary()),
                ]
            ),
        )

    return stored(
        texts.groupBy("seg")
        .cogroup(answers.groupBy("seg"))
        .applyInArrow(
            keep,
            "key long, node long, ids array<long>, size long, sketch array<long>, "
            "sigs array<long>, wide binary, elements binary",
        ),
        release=True,
    )


def linkable(texts: DataFrame, percent: int, segment_bytes: int) -> DataFrame:
    """The texts that may have a link, as a stored table.

    They have a signature in common with another, and enough elements: a link needs
    percent of a set in the other one, so a set of which more than the rest is in no
    other has none. Most texts that share no more than a passage go here, before any of
    them meet; no text that has a link does.
    """
    signed = texts.where("node is not null and size(sigs) > 0")
    own = unshared(signed.select("key", "size", "elements"), segment_bytes)
    may = own.join(signed.select("key", "size"), "key").where(
        100 * (F.col("size") - F.col("own")) >= percent * F.col("size")
    )
    return stored(signed.drop("ids").join(stored(may.select("key")), "key", "left_semi"), release=True)


def may_link(a: str, b: str, percent: int) -> Column:
    """False only for sets that are too far apart: by size, then by sketch."""
    size_a, size_b = F.col(f"{a}.size"), F.col(f"{b}.size")
    d = F.floor((size_a + size_b) * (100 - percent) / (100 + percent))
    bits = sum(
        F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i]))
        for i in range(SKETCH)
    )
    return (F.abs(size_a - size_b) <= d) & (bits <= d)


def _with_rows(pairs: DataFrame, texts: DataFrame, column: str) -> DataFrame:
    """The pairs with (size, value) of both, value being one column, as row_a and row_b."""

    def side(name: str) -> DataFrame:
        row = F.struct("size", F.col(column).alias("value"))
        return texts.select(F.col("node").alias(name), row.alias(f"row_{name}"))

    return pairs.join(side("a"), "a").join(side("b"), "b")


def _passing(
    pairs: DataFrame, texts: DataFrame, column: str, test: Callable[[dict, dict], bool]
) -> DataFrame:
    """The pairs (a, b) for which a test of the size and one column of each holds."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("row_a"), batch.column("row_b"))
            good = [test(x.as_py(), y.as_py()) for x, y in rows]
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    joined = _with_rows(pairs, texts, column)
    return joined.select("a", "b", "row_a", "row_b").mapInArrow(check, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, as a stored table.

    Wide sketches, a tenth of the sets, tell most of the other pairs apart; the
    sets themselves decide on the rest. ``pairs`` is stored in between, so that
    sets move for those only.
    """

    def near(x: dict, y: dict) -> bool:
        d = furthest(x["size"] + y["size"], percent)
        return sketch_distance(x["value"], y["value"]) <= d

    def similar(x: dict, y: dict) -> bool:
        s, t = np.frombuffer(x["value"], U), np.frombuffer(y["value"], U)
        both = int(found(s, t).sum())
        return 100 * both >= percent * (len(s) + len(t) - both)

    left = stored(_passing(pairs, texts, "wide", near), release=True)
    links = stored(_passing(left, texts, "elements", similar), release=True)
    drop(left)
    return links


#: Members of a signature that meet in one task of a join of all with all.
MEETING = 500


def _met(members: DataFrame) -> DataFrame:
    """Rows (p, q): all pairs of members (sig, m) of one signature, the one with
    the smaller m.node first; once for each signature that they share.

    A signature with many members is dealt into blocks, and each pair of blocks
    is a key of its own: no task gets more than a few blocks of a hot one.
    """
    counts = members.groupBy("sig").agg(F.ceil(F.count("*") / MEETING).alias("blocks"))
    dealt = members.join(counts, "sig").withColumn(
        "block", F.pmod(F.xxhash64("m.node"), F.col("blocks"))
    )
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    a = dealt.select("sig", F.col("block").alias("i"), F.explode(others).alias("j"), F.col("m").alias("p"))
    b = dealt.select("sig", F.explode(others).alias("i"), F.col("block").alias("j"), F.col("m").alias("q"))
    return a.join(b, ["sig", "i", "j"]).where("p.node < q.node")


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()


def _near(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and sketches do not rule out."""
    own = texts.select("node", F.struct("size", "sketch").alias("m"))
    p = own.select(F.col("node").alias("a"), F.col("m").alias("p"))
    q = own.select(F.col("node").alias("b"), F.col("m").alias("q"))
    both = pairs.join(p, "a").join(q, "b")
    return both.where(may_link("p", "q", percent)).select("a", "b")


#: Members of a signature whose pairs are listed; more are told apart by a pivot first.
FEW = 16
#: Roles of a member of a key: it links with the pivot; it doesn't, and meets all; it
#: doesn't, and meets those that do. Two meet if the product of their roles is 1 at most.
LINKED, OUTER, OUTER_LINKED = 0, 1, 2
#: Keys that a task gives at a time.
KEYS = 1 << 16


def difference_keys(
    pivot: np.ndarray, s: np.ndarray, percent: int
) -> tuple[np.ndarray, int, int]:
    """Elements in which a set differs from a pivot, by which it meets others: first
    those for all, whose number is given, then those for sets that link with the
    pivot. The last number is the size of the whole difference.

    Of two sets that link, x and y, let r be the sizes of their differences from the
    pivot and D the largest distance of linked sets of their sizes. The differences
    have (r_x + r_y - D) / 2 elements in common, or more. If that is 0 or less, x and
    y both link with the pivot: D grows less than the sizes do. Otherwise they meet in
    the first elements of an order, in all but as many as they have in common, less
    one. Elements that the pivot lacks come first, as they are the rarer ones.
    """
    added, removed = s[~found(s, pivot)], pivot[~found(pivot, s)]
    r = len(added) + len(removed)
    # No partner has more than furthest, so both have r - furthest in common.
    least = max(1, r - furthest(len(s) + len(s) * 100 // percent, percent))
    # A partner that doesn't link with the pivot is further from it than that.
    further = (len(pivot) - len(s)) * (100 - percent) // (100 + percent) + 1
    outer = max(least, -(-(r + further) // 2))
    keys = np.concatenate([added, removed])[: max(0, r - least + 1)]
    return keys, max(0, r - outer + 1), r


def _pivots(members: DataFrame) -> DataFrame:
    """Rows (sig, pivot), one for each signature of the members (sig, node, c); pivot is
    (degree, node, c) of a set.

    Any set can be the pivot of a signature. Each member names the one with the most
    signatures of all that it shares one with, and the most named is the pivot: the
    signatures of a family seldom have different ones, and its texts few pivots.
    """
    ranked = members.join(members.groupBy("node").agg(F.count("*").alias("degree")), "node")
    first = ranked.groupBy("sig").agg(F.max(F.struct("degree", "node", "c")).alias("pivot"))
    best = members.join(first, "sig").groupBy("node").agg(F.max("pivot").alias("pivot"))
    votes = members.join(best, "node").groupBy("sig", "pivot").agg(F.count("*").alias("votes"))
    return votes.groupBy("sig").agg(F.max(F.struct("votes", "pivot"))["pivot"].alias("pivot"))


def _measured(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored rows (a, b, element, role, size, r, rest): b's keys from a, the pivot of a
    signature of b, with b's role and size, the size of its difference from a and the
    number of elements after this one; and a row without an element for each b that
    links with an a of another component.
    """
    one = members.select("sig", "m.node", "m.c")
    pairs = (
        one.join(_pivots(one), "sig")
        .where("node <> pivot.node")
        .select(
            F.col("pivot.node").alias("a"),
            F.col("node").alias("b"),
            (F.col("pivot.c") != F.col("c")).alias("apart"),
        )
        .distinct()
    )
    ints = ["role", "size", "r", "rest"]
    schema = pa.schema(
        [(c, pa.int64()) for c in ("a", "b", "element")] + [(c, pa.int32()) for c in ints]
    )

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for a, b, apart, x, y in zip(*batch.columns):
                p, s = (np.frombuffer(v["value"].as_py(), U) for v in (x, y))
                elements, n, r = difference_keys(p, s, percent)
                linked = r <= furthest(len(p) + len(s), percent)
                if linked:
                    elements = elements[:n]
                place = np.arange(len(elements))
                role = LINKED if linked else np.where(place < n, OUTER, OUTER_LINKED)
                at = np.empty((4, len(elements)), np.int32)
                at[:] = [place * 0 + role, place * 0 + len(s), place * 0 + r, r - 1 - place]
                new = linked and apart.as_py()
                out.append((a.as_py(), b.as_py(), elements.view(np.int64), at, new))
                size += len(elements) + 1
                if size >= KEYS:
                    yield keys_of(out)
                    out, size = [], 0
        if out:
            yield keys_of(out)

    def keys_of(out: list[tuple]) -> pa.RecordBatch:
        sizes = [len(o[2]) for o in out]
        new = [o for o in out if o[4]]
        ends = [
            np.concatenate([np.repeat(ids, sizes), more]).astype(np.int64)
            for ids, more in (([o[i] for o in out], [o[i] for o in new]) for i in (0, 1))
        ]
        element = pa.array(np.concatenate([o[2] for o in out]))
        element = pa.concat_arrays([element, pa.nulls(len(new), pa.int64())])
        at = np.concatenate([*[o[3] for o in out], np.zeros((4, len(new)), np.int32)], axis=1)
        columns = [*map(pa.array, ends), element, *map(pa.array, at)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = _with_rows(pairs, sets, "elements").select("a", "b", "apart", "row_a", "row_b")
    return stored(
        rows.mapInArrow(keys, "a long, b long, element long, role int, size int, r int, rest int"),
        release=True,
    )


def _open(members: DataFrame, known: DataFrame) -> DataFrame:
    """Stored rows (sig, m, rows) of the members (sig, node, at) that have a member of
    another component to meet; m is (node, c, at), c the component as known, and
    rows the number of those members of the signature."""
    placed = members.join(known, "node", "left").select(
        "sig", "node", "at", F.coalesce("component", "node").alias("c")
    )
    least, outer = F.min("at.role"), F.count_if(F.col("at.role") == OUTER)
    mixed = (
        placed.groupBy("sig")
        .agg(
            F.min("c").alias("lo"),
            F.max("c").alias("hi"),
            least.alias("least"),
            F.when(least == LINKED, F.count("*")).otherwise(outer).alias("rows"),
        )
        .where((F.col("lo") < F.col("hi")) & (F.col("rows") > 1))
        .select("sig", "least", "rows")
    )
    return stored(
        placed.join(mixed, "sig")
        .where((F.col("least") == LINKED) | (F.col("at.role") == OUTER))
        .select("sig", F.struct("node", "c", "at").alias("m"), "rows"),
        release=True,
    )


def _meets(percent: int) -> Column:
    """False only for pairs (p, q) of a key that are of one component, that by their
    roles meet elsewhere, or whose differences have too few elements in common if this
    is the first one."""
    d = F.expr(f"(p.at.size + q.at.size) * {100 - percent} div {100 + percent}")
    wanted = F.col("p.at.r") + F.col("q.at.r") - d
    common = 1 + F.least("p.at.rest", "q.at.rest")
    roles = F.col("p.at.role") * F.col("q.at.role")
    return (F.col("p.c") != F.col("q.c")) & (roles <= 1) & (2 * common >= wanted)


def jaccard_links(
    docs: DataFrame, k: int = 5, percent: int = 80, segment_bytes: int = 4 << 20
) -> tuple[DataFrame, DataFrame]:
    """All verified links between distinct texts, and the texts.

    The links are stored rows (a, b) of two keys with a < b, each once, those
    within a component too. The texts are rows (key, node, ids, size): key is a
    hash of the text, ids are the doc_ids of its rows, which are copies of each
    other, node is the smallest of them. Texts without words or without a row
    that has a doc_id have no links. A family of n texts has up to the square of
    n links; that many are compared.
    """
    texts = prepared(docs, k, percent, segment_bytes)
    linked = linkable(texts, percent, segment_bytes).select(
        F.col("key").alias("node"), "size", "sketch", "sigs", "wide", "elements"
    )
    members = linked.select(
        F.explode(F.array_distinct("sigs")).alias("sig"), F.struct("node").alias("m")
    )
    # Only numbers meet; sketches go to the distinct pairs.
    links = verified(_near(_pairs(_met(members)), linked, percent), linked, percent)
    return links, texts.select("key", "node", "ids", "size")


def jaccard_degrees(
    docs: DataFrame, k: int = 5, percent: int = 80, segment_bytes: int = 4 << 20
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, n_links) for each row of (doc_id, text).

    n_links counts the other rows with a doc_id whose set is similar enough,
    copies included; the other columns are those of jaccard_components. Rows
    without a doc_id have null links, rows without words none.
    """
    links, texts = jaccard_links(docs, k, percent, segment_bytes)
    rows = F.size(F.filter("ids", lambda i: i.isNotNull()))
    own = texts.select("key", "node", rows.cast("long").alias("rows"))
    both = links.union(links.select("b", "a"))
    others = (
        both.join(own.select(F.col("key").alias("b"), "rows"), "b")
        .groupBy(F.col("a").alias("key"))
        .agg(F.sum("rows").alias("others"))
    )
    labels = components(
        links.join(own.select(F.col("key").alias("a"), F.col("node").alias("na")), "a")
        .join(own.select(F.col("key").alias("b"), F.col("node").alias("nb")), "b")
        .select(F.col("na").alias("a"), F.col("nb").alias("b"))
    )
    n_links = F.coalesce("others", F.lit(0)) + rows - 1
    counted = texts.join(others, "key", "left").withColumn(
        "links", F.when(F.col("size") == 0, F.lit(0)).otherwise(n_links).cast("long")
    )
    return (
        counted.join(labels, "node", "left")
        .select(
            F.explode("ids").alias("doc_id"),
            F.col("size").alias("n_shingles"),
            F.coalesce("component", "node").alias("component"),
            "links",
        )
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id"))
            .when(F.col("doc_id").isNotNull(), F.col("component"))
            .alias("component_id"),
            F.when(F.col("doc_id").isNotNull(), F.col("links")).alias("n_links"),
        )
    )


def jaccard_components(
    docs: DataFrame, k: int = 5, percent: int = 80, segment_bytes: int = 4 << 20
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) for each row of (doc_id, text).

    Two documents link when 100 * intersection >= percent * union of their sets
    of distinct k-word shingles; component_id is the smallest doc_id reachable
    by links. All texts with a signature in common are compared to the smallest
    of them first. Where texts in different components then remain, the pairs of
    a few are compared, if sizes and sketches allow a link; many meet only in what
    they differ in from one of them, see difference_keys. No link is lost, and none
    is listed within a component that is known already. A null text or one
    without words is linked with nothing. Rows without a doc_id take part in
    nothing and get a null component; rows that share a doc_id share a
    component. An empty table gives no rows.
    """
    texts = prepared(docs, k, percent, segment_bytes)
    linked = linkable(texts, percent, segment_bytes)
    sets = linked.select("node", "size", "wide", "elements")
    members = linked.select(F.explode(F.array_distinct("sigs")).alias("sig"), "node")
    first = members.groupBy("sig").agg(F.min("node").alias("a"))
    pairs = members.join(first, "sig").where("node <> a").select("a", F.col("node").alias("b"))
    links = verified(_near(pairs.distinct(), linked, percent), sets, percent)

    known = stored(components(links))
    zero = F.lit(0)
    anywhere = F.struct(
        F.lit(OUTER).alias("role"), zero.alias("size"), zero.alias("r"), zero.alias("rest")
    )
    left = _open(members.withColumn("at", anywhere), known)
    few, many = left.where(F.col("rows") <= FEW), left.where(F.col("rows") > FEW)
    past = [left]
    if not many.isEmpty():
        measured = _measured(many, sets, percent)
        new = measured.where("element is null").select("a", "b")
        if not new.isEmpty():
            known = stored(components(new.union(known)))
        keys = measured.where("element is not null").select(
            F.xxhash64("a", "element").alias("sig"),
            F.col("b").alias("node"),
            F.struct("role", "size", "r", "rest").alias("at"),
        )
        apart = _open(keys, known)
        drop(measured)
        few = few.union(apart)
        past.append(apart)
    met = _met(few.select("sig", "m")).where(_meets(percent))
    more = verified(_near(_pairs(met), linked, percent), sets, percent)
    for table in past:
        drop(table)

    labels = components(more.union(known))
    linked_to = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return (
        texts.join(labels, "node", "left")
        .select(
            F.explode("ids").alias("doc_id"),
            F.col("size").alias("n_shingles"),
            F.coalesce("component", "node").alias("component"),
        )
        .select(
            "doc_id",
            "n_shingles",
            # Rows without words share a text, but no link.
            F.when(F.col("n_shingles") == 0, F.col("doc_id"))
            .otherwise(linked_to)
            .alias("component_id"),
        )
    )

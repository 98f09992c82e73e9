"""Operator 12: a Merkle manifest whose leaves find their places by bitmap ranks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from whosaid.llm.tables import stored

#: Ids with the same upper 48 bits share a bitmap; one with more ids than this is
#: kept as bits, any other as a sorted list.
LOW = 16
DENSE = 4096
#: Bits of a directory level above the bitmaps.
STEP = 12

BITMAP = "key string, no_id boolean, k0 long, rows long, n long, ids binary, extra binary"
RANKED = "key string, slot long, total long, id long, leaf binary, check binary"
NODES = "key string, slot long, total long, node binary"
PATHS = (
    "key string, slot long, subroot binary, root binary, "
    "lefts array<string>, rights array<string>"
)
ROWS = (
    "id long, key string, slot long, leaf string, subroot string, root string, "
    "proof string, folded string"
)

_KINDS = {
    "string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(),
    "array<string>": pa.list_(pa.string()),
}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in ddl.split(", ")])


def leaf_hash(columns: Mapping[str, Column]) -> Column:
    """SHA-256 of the values, each with its length in bytes; "-" for null."""

    def spelled(value: Column) -> Column:
        text = value.cast("string")
        size = F.octet_length(text).cast("string")
        return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(spelled, columns.values())), 256))


def _packed(ids: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct sorted low parts as a list or as bits, and which occur more often."""
    more = times > 1
    extra = np.stack([ids[more], times[more] - 1]).astype(np.int64).tobytes()
    if len(ids) <= DENSE:
        return ids.astype(np.uint16).tobytes(), extra
    bits = np.zeros(1 << LOW, np.uint8)
    bits[ids] = 1
    return np.packbits(bits, bitorder="little").tobytes(), extra


def _unpacked(n: int, data: bytes) -> np.ndarray:
    if n <= DENSE:
        return np.frombuffer(data, np.uint16).astype(np.int64)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    return np.flatnonzero(bits)


def _extra(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(2, -1)


def _united(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    ids, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    times = np.bincount(where, np.concatenate([p[1] for p in parts]), len(ids))
    return ids, times.astype(np.int64)


def ranks(n: int, data: bytes, extra: bytes, ids: np.ndarray) -> np.ndarray:
    """How many rows of a bitmap stand before each of some low parts."""
    if n <= DENSE:
        before = np.searchsorted(np.frombuffer(data, np.uint16), ids)
    else:
        words = np.frombuffer(data, np.uint64)
        directory = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
        below = (np.uint64(1) << (ids & 63).astype(np.uint64)) - np.uint64(1)
        before = directory[ids >> 6] + np.bitwise_count(words[ids >> 6] & below)
    places, more = _extra(extra)
    total = np.concatenate([[0], np.cumsum(more)])
    return before.astype(np.int64) + total[np.searchsorted(places, ids)]


def bitmaps(leaves: DataFrame) -> DataFrame:
    """One bitmap per (key, no_id, k0): those of batches, merged."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas()
            out: list[tuple] = []
            for (key, no_id, k0), own in rows.groupby(["key", "no_id", "k0"], sort=False)["low"]:
                ids, times = np.unique(own.to_numpy(), return_counts=True)
                out.append((key, no_id, k0, len(own), len(ids), *_packed(ids, times)))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(columns, _schema(BITMAP))],
                schema=_schema(BITMAP),
            )

    def merge(parts: pa.Table) -> pa.Table:
        rows = parts.to_pylist()
        sets = []
        for r in rows:
            ids = _unpacked(r["n"], r["ids"])
            places, more = _extra(r["extra"])
            times = np.ones(len(ids), np.int64)
            times[np.searchsorted(ids, places)] += more
            sets.append((ids, times))
        ids, times = _united(sets)
        packed, extra = _packed(ids, times)
        head = {c: [rows[0][c]] for c in ("key", "no_id", "k0")}
        return pa.table(
            head | {"rows": [times.sum()], "n": [len(ids)], "ids": [packed], "extra": [extra]},
            schema=_schema(BITMAP),
        )

    low = F.col("code").bitwiseAND((1 << LOW) - 1).alias("low")
    return (
        leaves.select("key", "no_id", "k0", low)
        .mapInArrow(some, BITMAP)
        .groupBy("key", "no_id", "k0")
        .applyInArrow(merge, BITMAP)
    )


def directories(maps: DataFrame) -> DataFrame:
    """The bitmaps, each with the rows of its group before it (base) and in all.

    Counts go up a tree of id prefixes; a prefix adds those of its lesser
    siblings, at most 4,096 of them. No level sorts a whole group.
    """
    counted = maps.select("key", "no_id", "k0", "rows")
    sizes = counted
    base = counted.select("key", "no_id", "k0")
    for level in range(4):
        child, parent = f"k{level}", f"k{level + 1}"
        up = F.shiftright(child, STEP) if level < 3 else F.lit(0).cast("long")
        sizes = sizes.withColumn(parent, up)
        lesser = (
            Window.partitionBy("key", "no_id", parent)
            .orderBy(child)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        placed = sizes.select(
            "key", "no_id", child, parent,
            F.coalesce(F.sum("rows").over(lesser), F.lit(0)).alias(f"before{level}"),
        )
        base = base.join(placed, ["key", "no_id", child])
        sizes = sizes.groupBy("key", "no_id", parent).agg(F.sum("rows").alias("rows"))
    totals = counted.groupBy("key").agg(
        F.sum("rows").alias("total"),
        F.sum(F.when(F.col("no_id"), F.col("rows")).otherwise(0)).alias("first"),
    )
    before = sum((F.col(f"before{i}") for i in range(1, 4)), F.col("before0"))
    placed = base.join(totals, "key").select(
        "key", "no_id", "k0", "total",
        (before + F.when(F.col("no_id"), 0).otherwise(F.col("first"))).alias("base"),
    )
    return maps.join(placed, ["key", "no_id", "k0"])


def levels_of(total: int, fan: int) -> int:
    """Levels between a group's leaves and its root."""
    levels = 0
    while fan**levels < total:
        levels += 1
    return levels


def joined(nodes: Sequence[bytes], fan: int) -> list[bytes]:
    """The next level: the hash, in hex, of each run of nodes in hex."""
    return [
        hashlib.sha256(b"".join(nodes[i : i + fan])).hexdigest().encode()
        for i in range(0, len(nodes), fan)
    ]


def _levels(nodes: pa.Table, column: str, fan: int, depth: int) -> list[list[bytes]]:
    """The levels of a block: nodes in the array of their slots, then each above."""
    slots = nodes["slot"].to_numpy()
    placed: list[bytes] = [b""] * len(slots)
    base = fan**depth
    for slot, node in zip((slots % base).tolist(), nodes[column].to_pylist()):
        placed[slot] = node.hex().encode()
    levels = [placed]
    for _ in range(min(depth, levels_of(nodes["total"][0].as_py(), fan))):
        levels.append(joined(levels[-1], fan))
    return levels


def reduced(nodes: DataFrame, fan: int, depth: int) -> list[DataFrame]:
    """Stored tables of nodes, from those given up to one per key.

    A task reduces ``depth`` levels of a block of fan ** depth slots.
    """
    block = fan**depth
    tables = [nodes]
    while (tables[-1].agg(F.max("total")).first()[0] or 0) > 1:

        def fold(key: tuple, some: pa.Table) -> pa.Table:
            top = _levels(some, "node", fan, depth)[-1]
            total = -(-some["total"][0].as_py() // block)
            row = [key[0].as_py()], [key[1].as_py()], [total], [bytes.fromhex(top[0].decode())]
            return pa.table(list(row), schema=_schema(NODES))

        blocks = tables[-1].withColumn("block", F.expr(f"slot div {block}"))
        tables.append(stored(blocks.groupBy("key", "block").applyInArrow(fold, NODES)))
    return tables


def _block_paths(
    nodes: pa.Table, column: str, above: pa.Table, fan: int, depth: int
) -> Iterator[tuple[int, list[str], list[str]]]:
    """Per node, in the order of its rows, its slot and the siblings before and
    behind it on each level, up to the root."""
    levels = _levels(nodes, column, fan, depth)
    up = above.to_pylist()[0]
    for slot in nodes["slot"].to_pylist():
        at = slot % fan**depth
        lefts, rights = [], []
        for level in levels[:-1]:
            run = at - at % fan
            lefts.append(b"".join(level[run:at]).decode())
            rights.append(b"".join(level[at + 1 : run + fan]).decode())
            at //= fan
        yield slot, lefts + up["lefts"], rights + up["rights"]


def paths(tables: list[DataFrame], tops: DataFrame, fan: int, depth: int) -> DataFrame:
    """The paths (PATHS) of the second table of nodes, from those of the last."""
    block = fan**depth
    found = tops
    for nodes in tables[-2:0:-1]:

        def spread(some: pa.Table, above: pa.Table) -> pa.Table:
            up = above.to_pylist()[0]
            made = list(_block_paths(some, "node", above, fan, depth))
            n = len(made)
            return pa.table(
                {
                    "key": some["key"],
                    "slot": [m[0] for m in made],
                    "subroot": [up["subroot"]] * n,
                    "root": [up["root"]] * n,
                    "lefts": [m[1] for m in made],
                    "rights": [m[2] for m in made],
                },
                schema=_schema(PATHS),
            )

        found = _by_block(nodes, found, block).applyInArrow(spread, PATHS)
    return found


def _by_block(nodes: DataFrame, found: DataFrame, block: int):
    return (
        nodes.withColumn("block", F.expr(f"slot div {block}"))
        .groupBy("key", "block")
        .cogroup(found.groupBy("key", "slot"))
    )


def _in_order(subroots: DataFrame) -> DataFrame:
    """The keys with their places in order: that in a sorted part, after the
    rows of the parts before."""
    parts = stored(
        subroots.orderBy("key").select(
            "key", "node",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),
        )
    )
    sizes = parts.groupBy("part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
        F.sum("rows").over(Window.partitionBy()).alias("total"),
    )
    return stored(
        parts.join(offsets, "part").select(
            F.col("key").alias("lang"),
            F.lit("").alias("key"),
            (F.col("place") + F.col("offset")).alias("slot"),
            "total",
            "node",
        )
    )


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    identifier: str = "doc_id",
    group: str = "lang",
    checked: Mapping[str, Column] | None = None,
    fan: int = 8,
    depth: int = 4,
) -> DataFrame:
    """A leaf per row, its place, its proof, and whether a copy of the row proves it.

    Rows (doc_id, lang, slot, leaf, subroot, root, proof_sha256, folded_root,
    verified). A leaf is the hash of ``columns``; leaves of a ``group`` stand in the
    order of ``identifier``, and each run of ``fan`` nodes becomes their hash until
    one is left, the subroot. Subroots, null first, then by bytes, are reduced
    likewise to the root. proof_sha256 is the hash of a leaf's siblings, level by
    level. ``checked`` gives other values of some columns: folded_root is the root
    that a leaf of these and the siblings give, verified whether it is the root.

    A leaf's place is its rank: ids of a group are bitmaps of 65,536 ids, merged from
    those of batches, under directories of counts. Nodes are reduced in the arrays of
    their slots. Nothing but the keys of groups is sorted.

    Rows with a null id come first, in the order of their leaves; equal ids are in
    that order too. Rows of one id in a group are one task's: ids are thought to be
    keys. A null in any column has its own mark in the leaf. An empty table gives no
    rows; other columns are not read.
    """
    given = {c: F.col(f"`{c}`") for c in columns}
    leaf = leaf_hash(given)
    other = leaf_hash(given | dict(checked or {}))
    number = F.col(f"`{identifier}`").cast("long")
    key = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")), F.lit("0"))
    rows = docs.select(
        key.alias("key"),
        number.alias("id"),
        number.isNull().alias("no_id"),
        leaf.alias("leaf"),
        other.alias("check"),
    )
    # The order of bytes as that of signed numbers.
    from_leaf = F.conv(F.substring(F.hex("leaf"), 1, 16), 16, -10).cast("long")
    code = F.coalesce("id", from_leaf.bitwiseXOR(F.lit(-(1 << 63))))
    leaves = stored(
        rows.withColumn("code", code).withColumn("k0", F.shiftright("code", LOW))
    )

    placed = directories(stored(bitmaps(leaves)))

    def place(some: pa.Table, bitmap: pa.Table) -> pa.Table:
        b = bitmap.to_pylist()[0]
        low = some["code"].to_numpy() & ((1 << LOW) - 1)
        slots = b["base"] + ranks(b["n"], b["ids"], b["extra"], low)
        if len(_extra(b["extra"])[0]):
            # Rows of one id take the places behind its first, by their leaves.
            order = sorted(range(len(slots)), key=lambda i: (slots[i], some["leaf"][i].as_py()))
            ordered = slots[order]
            first = np.searchsorted(ordered, ordered)
            slots[order] = ordered + np.arange(len(ordered)) - first
        return pa.table(
            {
                "key": some["key"],
                "slot": slots,
                "total": np.full(len(slots), b["total"]),
                "id": some["id"],
                "leaf": some["leaf"],
                "check": some["check"],
            },
            schema=_schema(RANKED),
        )

    by = ["key", "no_id", "k0"]
    ranked = stored(
        leaves.groupBy(*by).cogroup(placed.groupBy(*by)).applyInArrow(place, RANKED)
    )
    nodes = ranked.select("key", "slot", "total", F.col("leaf").alias("node"))
    tables = reduced(nodes, fan, depth)

    groups = _in_order(tables[-1].select("key", "node"))
    upper = reduced(groups.select("key", "slot", "total", "node"), fan, depth)
    root = upper[-1].select(
        "key", F.lit(0).cast("long").alias("slot"), F.col("node").alias("subroot"),
        F.col("node").alias("root"), F.array().cast("array<string>").alias("lefts"),
        F.array().cast("array<string>").alias("rights"),
    )
    to_root = paths([None, *upper], root, fan, depth) if len(upper) > 1 else root
    tops = to_root.join(groups.select("slot", "lang", "node"), "slot").select(
        F.col("lang").alias("key"), F.lit(0).cast("long").alias("slot"),
        F.col("node").alias("subroot"), "root", "lefts", "rights",
    )
    found = paths(tables, tops, fan, depth)

    def prove(some: pa.Table, above: pa.Table) -> pa.Table:
        up = above.to_pylist()[0]
        out: dict[str, list] = {c.split()[0]: [] for c in ROWS.split(", ")}
        made = _block_paths(some, "leaf", above, fan, depth)
        for row, (slot, lefts, rights) in zip(some.to_pylist(), made):
            siblings = (t for pair in zip(lefts, rights) for t in pair)
            node = row["check"].hex()
            for left, right in zip(lefts, rights):
                node = hashlib.sha256(f"{left}{node}{right}".encode()).hexdigest()
            out["id"].append(row["id"])
            out["key"].append(row["key"])
            out["slot"].append(slot)
            out["leaf"].append(row["leaf"].hex())
            out["subroot"].append(up["subroot"].hex())
            out["root"].append(up["root"].hex())
            out["proof"].append(hashlib.sha256("".join(siblings).encode()).hexdigest())
            out["folded"].append(node)
        return pa.table(out, schema=_schema(ROWS))

    proved = _by_block(ranked, found, fan**depth).applyInArrow(prove, ROWS)
    return proved.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("key") != "0", F.substring("key", F.lit(2), F.length("key"))).alias("lang"),
        "slot",
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )

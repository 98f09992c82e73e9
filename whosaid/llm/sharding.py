"""Operator 2: shards by a k-d tree over metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from whosaid.llm.tables import drop, stored

#: Bits of a coordinate and of the order among equal ones; digits of the key
#: that one histogram resolves, and the number of histograms.
COORDINATE, TIE, DIGIT, DIGITS = 20, 40, 15, 4
#: Copies of a text stay together up to this share of a shard's target.
TOGETHER = 0.05
#: Rows are numbered within this many parts of a shard.
SLOT_PARTS = 256


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_order(column: Column) -> Column:
    """The first seven bytes of a text as a number, in the texts' order."""
    digits = F.rpad(F.hex(F.substring(F.encode(column, "utf-8"), 1, 7)), 14, "0")
    return F.conv(digits, 16, 10).cast("double")


def shards(
    docs: DataFrame,
    dims: Sequence[Column],
    target_bytes: int | None = None,
    n_shards: int | None = None,
) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot) for each row of docs.

    A k-d tree over ``dims``, numbers of a row's metadata. A node of n shards is
    cut along its widest dimension (the first of equals) where the bytes on the
    left are nearest to n // 2 shards' part, until every node is one shard. The
    number of shards is given, or it is the least that keeps the mean at
    ``target_bytes``. Shards have about equal bytes; slots number the rows of a
    shard from 0.

    Copies of a text have the place of one of them, and one shard, as long as
    they are not above a twentieth of a shard: a larger group is dealt row by
    row. Among equal coordinates the hash of the text decides. A missing
    coordinate counts as the lowest, a null text has size 1, an empty table
    gives no rows, and repeated rows are rows of their own.

    The median of a node is found digit by digit of a 60-bit key, from a
    histogram of bytes by digit: tables of at most 2^15 rows a node, whatever
    the rows, summed before each shuffle.
    """
    points = _points(docs, dims, target_bytes, n_shards)
    coords = [f"q{i}" for i in range(len(dims))]
    levels = max(0, ((points.agg(F.max("n")).first()[0] or 1) - 1).bit_length())
    for _ in range(levels):
        nodes, keyed = _keyed(points, coords)
        cut = stored(_cut(points, coords, nodes, keyed))
        for past in (nodes, keyed, points):
            drop(past)
        points = cut
    return _numbered(points.withColumn("shard", F.col("lo").cast("int")))


def _points(
    docs: DataFrame, dims: Sequence[Column], target_bytes: int | None, n_shards: int | None
) -> DataFrame:
    """The narrow rows that are cut: size, coordinates, tie order, node (lo, n)."""
    if (target_bytes is None) == (n_shards is None):
        raise ValueError("give target_bytes or n_shards")
    raw = [f"x{i}" for i in range(len(dims))]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            text_size(F.col("text")).alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.xxhash64(F.col("text").isNull(), text).alias("group"),
            *[F.coalesce(d.cast("double"), F.lit(float("-inf"))).alias(x) for d, x in zip(dims, raw)],
        )
    )
    finite = [F.when(F.col(x) > float("-inf"), F.col(x)) for x in raw]
    limits = [F.min(f).alias(f"min_{x}") for f, x in zip(finite, raw)]
    limits += [F.max(f).alias(f"max_{x}") for f, x in zip(finite, raw)]
    total = F.coalesce(F.sum("size"), F.lit(1)).alias("total")
    if n_shards is None:
        n = F.ceil(F.col("total") / target_bytes)
    else:
        n = F.lit(n_shards)
    # One row.
    whole = F.broadcast(rows.agg(total, *limits).withColumn("n", n.cast("long")))
    groups = rows.groupBy("group").agg(
        F.sum("size").alias("group_size"), *[F.min(x).alias(f"g_{x}") for x in raw]
    )
    dealt = F.col("group_size") > F.col("total") / F.col("n") * TOGETHER
    steps = (1 << COORDINATE) - 1

    def coordinate(x: str) -> Column:
        value = F.when(F.col("dealt"), F.col(x)).otherwise(F.col(f"g_{x}"))
        width = F.col(f"max_{x}") - F.col(f"min_{x}")
        place = F.when(width > 0, (value - F.col(f"min_{x}")) / width * steps).otherwise(0)
        return F.greatest(F.coalesce(F.floor(place), F.lit(0)), F.lit(0)).cast("long")

    order = F.when(
        F.col("dealt"), F.xxhash64("group", "doc_id")
    ).otherwise(F.xxhash64("group"))
    return stored(
        rows.join(groups, "group")
        .join(whole)
        .withColumn("dealt", dealt)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            *[coordinate(x).alias(f"q{i}") for i, x in enumerate(raw)],
            F.shiftrightunsigned(order, 64 - TIE).alias("tie"),
            F.lit(0).cast("long").alias("lo"),
            "n",
        )
    )


def _key(coords: Sequence[str]) -> Column:
    along = F.element_at(F.array(*coords), F.col("dim"))
    return F.shiftleft(along, TIE).bitwiseOR(F.col("tie"))


def _keyed(points: DataFrame, coords: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The nodes of two shards or more, and the keys of their points, as stored tables:
    each histogram reads the keys, none joins the points to their nodes again."""
    spread = [(F.max(q) - F.min(q)).alias(f"w_{q}") for q in coords]
    nodes = points.where("n > 1").groupBy("lo", "n").agg(F.sum("size").alias("bytes"), *spread)
    widest = F.array_max(F.array(*[F.col(f"w_{q}") for q in coords]))
    dim = F.array_position(F.array(*[F.col(f"w_{q}") for q in coords]), widest)
    nodes = stored(
        nodes.select(
            "lo",
            dim.cast("int").alias("dim"),
            # The bytes of the left part, as near as rows allow.
            (F.col("bytes") * F.floor(F.col("n") / 2) / F.col("n")).alias("wanted"),
        )
    )
    key = _key(coords).alias("key")
    keyed = points.join(nodes.select("lo", "dim"), "lo").select("lo", "size", key)
    return nodes, stored(keyed)


def _cut(
    points: DataFrame, coords: Sequence[str], nodes: DataFrame, keyed: DataFrame
) -> DataFrame:
    """Each node of two shards or more in two."""
    # state: the key's first digits at the cut, and the bytes below them.
    state = nodes.select(
        "lo", "wanted", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below")
    )
    for step in range(DIGITS):
        shift = DIGIT * (DIGITS - 1 - step)
        number = F.shiftright("key", shift)
        rows = keyed if step == 0 else keyed.join(
            state.select("lo", "prefix"), "lo"
        ).where(F.shiftright("key", shift + DIGIT) == F.col("prefix"))
        bars = rows.groupBy("lo", number.alias("digits")).agg(F.sum("size").alias("bytes"))
        upto = F.sum("bytes").over(Window.partitionBy("lo").orderBy("digits"))
        state = (
            bars.withColumn("upto", upto)
            .join(state.select("lo", "wanted", "below"), "lo")
            # The bar in which the wanted bytes are reached, or the last one.
            .withColumn("reached", F.col("below") + F.col("upto") >= F.col("wanted"))
            .groupBy("lo", "wanted", "below")
            .agg(
                F.min(
                    F.struct(
                        (~F.col("reached")).alias("late"),
                        F.when(F.col("reached"), F.col("digits"))
                        .otherwise(-F.col("digits"))
                        .alias("place"),
                        "digits",
                        (F.col("below") + F.col("upto") - F.col("bytes")).alias("under"),
                        "bytes",
                    )
                ).alias("b")
            )
            .select(
                "lo",
                "wanted",
                F.col("b.digits").alias("prefix"),
                F.col("b.under").alias("below"),
                F.col("b.bytes").alias("bytes"),
            )
        )
    # The rows at the cut go to the side that leaves the bytes nearer.
    take = F.col("below") + F.col("bytes") - F.col("wanted") <= F.col("wanted") - F.col("below")
    cut = state.select("lo", F.when(take, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("cut"))
    left = F.floor(F.col("n") / 2)
    goes_right = _key(coords) > F.col("cut")
    placed = points.join(nodes.select("lo", "dim"), "lo", "left").join(cut, "lo", "left")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        *coords,
        "tie",
        F.when(F.col("cut").isNull(), F.col("lo"))
        .when(goes_right, F.col("lo") + left)
        .otherwise(F.col("lo"))
        .alias("lo"),
        F.when(F.col("cut").isNull(), F.col("n"))
        .when(goes_right, F.col("n") - left)
        .otherwise(left)
        .cast("long")
        .alias("n"),
    )


def _numbered(points: DataFrame) -> DataFrame:
    """Slots from 0 in each shard: by part of the shard, then within it."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SLOT_PARTS)).alias("part")
    rows = points.select("doc_id", "size", "text_crc32", "shard", part)
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(
        "shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("ahead")
    )
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return rows.join(ahead, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("ahead") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
    )

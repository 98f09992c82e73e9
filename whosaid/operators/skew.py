"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rows of one key that a task is given; a key with more is hot.
HOT_ROWS = 100_000


def key_parts(df: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """Rows (_key, _parts): each key of a table once, and how many tasks' work
    its rows are.

    A table, whatever its size: nothing of it goes to the driver. Rows are
    counted before the shuffle. Null is no key.
    """
    rows = F.ceil(F.count(F.lit(1)) / (HOT_ROWS if hot_rows is None else hot_rows))
    known = df.where(F.col(key).isNotNull())
    return known.groupBy(F.col(key).alias("_key")).agg(rows.alias("_parts"))


def _own_part(df: DataFrame, parts: Column) -> Column:
    """A row's part, from its values and its partition's number, not from a
    random draw: a task that is run again deals its rows the same way, and
    copies of one row still spread."""
    values = [F.col(f"`{c}`") for c in df.columns]
    return F.pmod(F.xxhash64(*values) + F.spark_partition_id(), parts)


def _each_part(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    hot_rows: int | None = None,
    left_is_hot: bool = False,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    deal_left: bool = False,
    combine: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Inner equi-join in which hot keys go to many tasks.

    Left rows without a partner go first: they meet the list of the right
    side's keys, by the key, and stay partitioned by it. ``prepare`` may then
    change what is left, row by row or key by key; it must keep the key,
    ``_parts`` and ``_left``. Cold keys are joined right there. Rows of a hot key,
    few on the left, are dealt into parts on the right, and the left's rows copied
    to each. With ``left_is_hot`` a key is also hot for its rows on the left, which
    are then dealt as well.

    With ``deal_left`` the left's keys are counted by a pass of their own and the
    rows of its hot keys dealt before they move. The list of those keys is
    broadcast: each has more than ``hot_rows`` rows, so a table of N rows has at
    most N / hot_rows of them. ``prepare`` sees one part of a hot key at a time;
    where it works key by key, ``combine`` does the same over a key's parts.

    One plan for all sizes, and no job while it is built. Columns of both sides
    are kept, but for the right key where the names are the same.
    """
    types = left.schema[left_key].dataType, right.schema[right_key].dataType
    if types[0] != types[1]:
        # Equal values of two types have different hashes.
        raise TypeError(f"keys of types {types[0]} and {types[1]} cannot be spread")
    parts = key_parts(right, right_key, hot_rows)
    columns = left.columns
    own = key_parts(left, left_key, hot_rows).withColumnRenamed("_parts", "_own")
    one = F.lit(1).cast("bigint")
    if deal_left:
        few = own.where("_own > 1")
        on = F.col(left_key) == F.col("_key")
        part = F.when(F.col("_own").isNull(), 0).otherwise(_own_part(left, F.col("_own")))
        dealt = left.join(F.broadcast(few), on, "left").select(*columns, part.alias("_left"))
        parts = parts.join(F.broadcast(few), "_key", "left").select(
            "_key", _both_parts(F.coalesce("_own", one)), _each_part(F.coalesce("_own", one)).alias("_at")
        )
        on = (F.col(left_key) == F.col("_key")) & (F.col("_left") == F.col("_at"))
        kept = dealt.join(parts, on).drop("_key", "_at")
        parts = parts.where("_at = 0").drop("_at")
    else:
        if left_is_hot:
            parts = parts.join(own, "_key").select("_key", _both_parts(F.col("_own")))
        else:
            parts = parts.select("_key", _both_parts(one))
        kept = left.join(parts, F.col(left_key) == F.col("_key")).drop("_key")
        at_left = F.lit(0).cast("bigint")
        if prepare is None:
            at_left = _own_part(left, F.col("_parts.left"))
        kept = kept.withColumn("_left", at_left)
    hot = (F.col("_parts.right") > 1) | (F.col("_parts.left") > 1)

    if prepare is not None:
        kept = prepare(kept)
        columns = [c for c in kept.columns if c not in ("_parts", "_left")]
    few = parts.where(hot).withColumnRenamed("_parts", "_dealt")
    marked = right.join(few, F.col(right_key) == F.col("_key"), "left").drop("_key")

    cold = _equi_join(
        kept.where(~hot).select(columns),
        marked.where(F.col("_dealt").isNull()).drop("_dealt"),
        left_key,
        right_key,
        [],
    )
    hot_left, left_parts = kept.where(hot), F.col("_dealt.left")
    if combine is not None:
        hot_left = combine(hot_left).withColumn("_left", F.lit(0).cast("bigint"))
        left_parts = one
    hot_left = hot_left.select(
        *columns, "_left", _each_part(F.col("_parts.right")).alias("_right")
    )
    hot_right = (
        marked.where(F.col("_dealt").isNotNull())
        .withColumn("_right", _own_part(right, F.col("_dealt.right")))
        .select(*right.columns, "_right", _each_part(left_parts).alias("_left"))
    )
    dealt = _equi_join(hot_left, hot_right, left_key, right_key, ["_left", "_right"])
    return cold.union(dealt.drop("_left", "_right").select(cold.columns))


def _both_parts(own: Column) -> Column:
    return F.struct(F.col("_parts").alias("right"), own.alias("left")).alias("_parts")


def _equi_join(left, right, left_key, right_key, parts):
    if left_key == right_key:
        return left.join(right, [left_key, *parts], "inner")
    right = right.withColumnsRenamed({p: f"{p}_r" for p in parts})
    on = [F.col(left_key) == F.col(right_key)]
    on += [F.col(p) == F.col(f"{p}_r") for p in parts]
    return left.join(right, on, "inner").drop(*[f"{p}_r" for p in parts])

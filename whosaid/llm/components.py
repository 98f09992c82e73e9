"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from whosaid.llm.tables import drop, stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, component) for each end of a link (a, b); component is the
    smallest node of the component.

    In each round every node takes the label of the neighbour that comes first
    in a random order of that round, twice in a row, and the links are
    contracted to labels; the image of a component stays connected, and its
    number of labels falls by a factor. The first neighbour is found before the
    shuffle, so that a hub costs a row per task. Each round is stored in the
    shared folder; the driver only asks whether links are left. Nulls are no nodes; repeated
    links and loops do no harm; no links give no rows.
    """
    links = links.select("a", "b").dropna()
    ends = stored(
        links.select(F.col("a").alias("node"))
        .union(links.select(F.col("b").alias("node")))
        .distinct()
        .withColumn("label", F.col("node"))
    )
    edges = stored(
        links.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    for turn in range(rounds):
        if edges.isEmpty():
            break
        step = stored(_steps(edges, turn))
        moved = stored(
            ends.join(step, F.col("label") == F.col("old"), "left").select(
                "node", F.coalesce("new", "label").alias("label")
            )
        )
        left = step.select(F.col("old").alias("a"), F.col("new").alias("na"))
        right = step.select(F.col("old").alias("b"), F.col("new").alias("nb"))
        contracted = stored(
            edges.join(left, "a")
            .join(right, "b")
            .where("na <> nb")
            .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
            .distinct()
        )
        for past in (ends, edges, step):
            drop(past)
        ends, edges = moved, contracted
    else:
        raise RuntimeError(f"links are left after {rounds} rounds")
    smallest = ends.groupBy("label").agg(F.min("node").alias("component"))
    return ends.join(smallest, "label").select("node", "component")


def _steps(edges: DataFrame, turn: int) -> DataFrame:
    """Rows (old, new): the first of a label and its neighbours, twice over."""

    def key(c: str) -> Column:
        return F.xxhash64(F.lit(turn), F.col(c))

    both = edges.union(edges.select("b", "a"))
    first = both.groupBy("a").agg(F.min(key("b")).alias("k"), F.min_by("b", key("b")).alias("b"))
    once = first.select(
        F.col("a").alias("old"), F.when(F.col("k") < key("a"), F.col("b")).otherwise(F.col("a")).alias("new")
    )
    twice = once.select(F.col("old").alias("new"), F.col("new").alias("newer"))
    return once.join(twice, "new").select("old", F.col("newer").alias("new"))

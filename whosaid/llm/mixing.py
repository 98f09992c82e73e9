"""Operator 10: mixing sources to target weights by hierarchical budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from whosaid.llm.tables import stored

#: Hexadecimal digits of the order key that name a stretch of a leaf's epoch.
STRETCH = 3
#: The leaves' plan is broadcast up to this many leaves.
BROADCAST_LEAVES = 100_000

#: One level of the tree: its name, a row's node and that node's whole weight.
Level = tuple[str, Column, Column]


def estimated_tokens(text: Column) -> Column:
    """Four UTF-8 bytes a token, rounded up; a null text has none."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return F.floor((size + 3) / 4).cast("long")


def shared_out(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Budgets of siblings: rows with a node's weight, its capacity and its
    parent's budget ``given`` get ``budget``.

    Each gets the parent's budget in proportion to its weight, but no more than
    its capacity; what is short there goes to its siblings in proportion to
    theirs. In the order of capacity by weight, nodes that get all their
    capacity come first, and the others share what is left. All numbers are
    whole; parts of a token are dropped.
    """
    exact = {c: F.col(c).cast("decimal(20,0)") for c in ("given", "capacity", "weight")}
    by = Window.partitionBy(*parent).orderBy(
        (F.col("capacity").cast("double") / F.col("weight").cast("double")), name
    )
    family = Window.partitionBy(*parent)
    placed = nodes.withColumns(exact).withColumns(
        {
            "ahead": F.coalesce(
                F.sum("capacity").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
            "behind": F.coalesce(
                F.sum("weight").over(by.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)
            ),
        }
    )
    left = (F.col("given") - F.col("ahead") - F.col("capacity")).cast("decimal(20,0)")
    placed = placed.withColumn(
        "full",
        left * F.col("weight") >= F.col("capacity") * F.col("behind").cast("decimal(18,0)"),
    ).withColumns(
        {
            "taken": F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(family),
            "heavy": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(family),
        }
    )
    share = F.expr(
        "(cast(given - taken as decimal(20,0)) * cast(weight as decimal(18,0)))"
        " div cast(heavy as decimal(20,0))"
    )
    return placed.withColumn(
        "budget",
        F.when(F.col("full"), F.col("capacity")).otherwise(share).cast("long"),
    ).drop("ahead", "behind", "full", "taken", "heavy", "given", "capacity", "weight")


def leaf_budgets(leaves: DataFrame, names: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Budgets of leaves, from the root down.

    ``leaves`` has a row for each leaf: its nodes by name, their weights by
    ``w_<name>``, and its capacity; ``wanted`` is one row with the mixture's
    tokens. A node's capacity is that of its leaves, so that a shortage is made
    up within a node as far as its leaves go, and only the rest by its siblings.
    """
    total = leaves.agg(F.coalesce(F.sum("capacity"), F.lit(0)).alias("most"))
    # One row each.
    given = F.broadcast(
        wanted.join(F.broadcast(total)).select(F.least("wanted", "most").alias("given"))
    )
    for i, name in enumerate(names):
        parent, path = list(names[:i]), list(names[: i + 1])
        nodes = leaves.groupBy(*path).agg(
            F.sum("capacity").alias("capacity"), F.max(f"w_{name}").alias("weight")
        )
        joined = nodes.join(given, parent) if parent else nodes.join(given)
        given = shared_out(joined, parent, name).withColumnRenamed("budget", "given")
    return given.withColumnRenamed("given", "budget")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Where a row stands in an epoch: every epoch has an order of its own."""
    given = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), given))


def leaf_plans(
    rows: DataFrame, names: Sequence[str], budget: Column, max_epochs: int, seed: int
) -> DataFrame:
    """One row per leaf: its budget, its number of whole epochs, and the key up
    to which rows of the next epoch fit the rest (null: none).

    ``rows`` is narrow: a row's nodes and their weights, doc_id and tokens. The
    order of an epoch is cut into stretches by the key's first digits: running
    totals go over the stretches of a leaf, then over the rows of the one in
    which its budget ends. No task sees the rows of a whole leaf.
    """
    leaves = rows.groupBy(*names).agg(
        F.sum("tokens").alias("leaf_tokens"),
        *[F.max(f"w_{n}").alias(f"w_{n}") for n in names],
    )
    leaves = stored(leaves.withColumn("capacity", F.col("leaf_tokens") * max_epochs))
    wanted = leaves.agg(F.coalesce(F.sum("leaf_tokens"), F.lit(0)).alias("total")).select(
        budget.cast("long").alias("wanted")
    )
    plan = stored(
        leaves.join(leaf_budgets(leaves, names, wanted), list(names))
        .withColumn(
            "whole", F.expr("if(leaf_tokens > 0, budget div leaf_tokens, 0)").cast("int")
        )
        .withColumn("part", F.col("budget") - F.col("whole") * F.col("leaf_tokens"))
        .select(*names, "budget", "whole", "part")
    )
    key = order_key(seed, F.col("whole"), F.col("doc_id"))
    keyed = rows.join(plan.where("part > 0"), list(names)).select(
        *names, "part", "tokens", key.alias("key"), F.substring(key, 1, STRETCH).alias("stretch")
    )
    along = Window.partitionBy(*names).orderBy("stretch")
    ends = (
        keyed.groupBy(*names, "part", "stretch")
        .agg(F.sum("tokens").alias("n"), F.max("key").alias("last"))
        .withColumn("upto", F.sum("n").over(along))
    )
    full = ends.where("upto <= part").groupBy(*names).agg(F.max("last").alias("full_cut"))
    first_open = (
        ends.where("upto > part")
        .groupBy(*names)
        .agg(F.min(F.struct("stretch", (F.col("upto") - F.col("n")).alias("ahead"))).alias("o"))
        .select(*names, "o.stretch", "o.ahead")
    )
    within = (
        keyed.join(first_open, [*names, "stretch"])
        .groupBy(*names, "part", "ahead", "key")
        .agg(F.sum("tokens").alias("n"))
        .withColumn(
            "upto", F.col("ahead") + F.sum("n").over(Window.partitionBy(*names).orderBy("key"))
        )
        .where("upto <= part")
        .groupBy(*names)
        .agg(F.max("key").alias("open_cut"))
    )
    return (
        plan.join(full, list(names), "left")
        .join(within, list(names), "left")
        .select(*names, "budget", "whole", F.greatest("full_cut", "open_cut").alias("cut"))
    )


def mixed(
    docs: DataFrame,
    levels: Sequence[Level],
    budget: Column,
    max_epochs: int = 2,
    seed: int = 1,
) -> DataFrame:
    """The rows of a mixture: all columns of ``docs`` under ``doc``, the nodes,
    the leaf's ``budget``, the row's ``tokens`` and its ``epoch``.

    ``levels`` go from the tree's root to its leaves; a weight is whole, above
    zero and a function of the path to the node. ``budget`` is the mixture's
    number of tokens, as an expression over ``total``, the tokens of all rows.
    A leaf gives whole epochs, at most ``max_epochs``, and of the next one the
    rows in seeded order for as long as they fit its budget whole. A null node
    is a node like any other. Rows with one doc_id stand together in an epoch's
    order. An empty table gives no rows.

    Texts are not shuffled: the plan has one row per leaf, and a row compares
    its key with its leaf's.
    """
    names = [f"node_{name}" for name, _, _ in levels]
    nodes = [F.coalesce(node.cast("string"), F.lit("")).alias(n) for n, (_, node, _) in zip(names, levels)]
    weights = [w.cast("long").alias(f"w_{n}") for n, (_, _, w) in zip(names, levels)]
    tokens = estimated_tokens(F.col("text")).alias("tokens")
    rows = stored(docs.select(*nodes, *weights, "doc_id", tokens))
    plan = stored(leaf_plans(rows, names, budget, max_epochs, seed))
    if plan.count() <= BROADCAST_LEAVES:
        plan = F.broadcast(plan)
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *nodes, tokens)
    key = order_key(seed, F.col("whole"), F.col("doc.doc_id"))
    epochs = F.col("whole") + F.when(key <= F.col("cut"), 1).otherwise(0)
    return (
        carried.join(plan, names)
        .withColumn("epochs", epochs)
        .where("epochs > 0")
        .select(
            "doc",
            *names,
            "budget",
            "tokens",
            F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)).alias("epoch"),
        )
    )

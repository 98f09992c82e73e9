"""Operator 12 against a plain tree over sorted rows."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from whosaid.llm.merkle import _packed, merkle_manifest, ranks

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    def spelled(value):
        if value is None:
            return "-"
        return f"{len(str(value).encode())}:{value}"

    return hashed(*(spelled(row[c]) for c in COLUMNS))


def climbed(nodes, fan):
    """Per node, its siblings on each level as (before, behind); and the top."""
    paths = [[] for _ in nodes]
    level, owners = list(nodes), [[i] for i in range(len(nodes))]
    while len(level) > 1:
        above, above_owners = [], []
        for i in range(0, len(level), fan):
            run = level[i : i + fan]
            for j in range(len(run)):
                for o in owners[i + j]:
                    paths[o].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(hashed(*run))
            above_owners.append([o for j in range(len(run)) for o in owners[i + j]])
        level, owners = above, above_owners
    return paths, level[0]


def brute(rows, tampered, fan=8):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[1]["doc_id"] is not None, r[1]["doc_id"] or 0, r[0]))
        trees[g] = climbed([h for h, _ in groups[g]], fan)
    upper, root = climbed([trees[g][1] for g in order], fan)
    out = []
    for g, up in zip(order, upper):
        for slot, ((own, row), path) in enumerate(zip(groups[g], trees[g][0])):
            whole = path + up
            node = leaf(tampered(row))
            for left, right in whole:
                node = hashed(left, node, right)
            proof = hashed(*(t for pair in whole for t in pair))
            out.append((row["doc_id"], g, slot, own, trees[g][1], root, proof, node, node == root))
    return collections.Counter(out)


def lowered(row):
    if row["doc_id"] is None or row["doc_id"] % 3 or row["text"] is None:
        return row
    text = "".join(c.lower() if c.isascii() else c for c in row["text"])
    return row | {"text": text}


def lower_text():
    fold = F.call_function("translate", "text", F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.lit("abcdefghijklmnopqrstuvwxyz"))
    return {"text": F.when(F.col("doc_id") % 3 == 0, fold).otherwise(F.col("text"))}


def check(df, **options):
    rows = [{c: r[c] for c in COLUMNS} for r in df.collect()]
    got = merkle_manifest(df, checked=lower_text(), **options)
    assert got.columns == [
        "doc_id", "lang", "slot", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        "verified",
    ]
    assert collections.Counter(map(tuple, got.collect())) == brute(rows, lowered, options.get("fan", 8))


@pytest.mark.parametrize("options", [{}, {"depth": 1}, {"fan": 3, "depth": 2}])
def test_against_a_plain_tree(spark, options):
    clashing = {c: F.lit(7) for c in ("key", "no_id", "code", "k0", "low", "slot", "total", "leaf", "check")}
    check(plain.frame(spark, plain.odd_texts(3)).withColumns(clashing), **options)


def test_ids_far_apart_and_many_groups(spark):
    rng = random.Random(5)
    ids = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(150)] + [0, -1, (1 << 63) - 1, -(1 << 63)]
    rows = [(i, "T", rng.choice([None, "", "b", "ä", "Z"] + [f"l{n}" for n in range(12)]), "s", 1) for i in ids]
    rows += [(None, f"Text {i}", "b", None, None) for i in range(20)] + rows[:5] * 2
    check(spark.createDataFrame(rows, plain.DOCUMENTS))


def test_a_dense_bitmap(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"),
        F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.lit(3).cast("long").alias("n_chars"),
    )
    check(rows)


def test_ranks_of_both_kinds_of_bitmap():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 100, 4096, 4097, 60000):
        ids = np.sort(rng.choice(1 << 16, n, replace=False)).astype(np.int64)
        times = rng.integers(1, 4, n)
        data, extra = _packed(ids, times)
        assert (ranks(n, data, extra, ids) == np.cumsum(times) - times).all()


def test_one_row_and_none(spark):
    check(spark.createDataFrame([(1, "A", None, None, None)], plain.DOCUMENTS))
    assert merkle_manifest(plain.empty(spark)).collect() == []

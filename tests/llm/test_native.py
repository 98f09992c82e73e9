"""Mixing and sharding."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from whosaid.llm import sharding
from whosaid.llm.mixing import mixed
from whosaid.llm.queries import mixture_levels, op2_sharding, shard_dims
from whosaid.llm.sharding import shards


def plain_shares(budget, nodes):
    """Budgets of (name, weight, capacity) by filling up the fullest in turn."""
    open_, out = dict((n, (w, c)) for n, w, c in nodes), {}
    while open_:
        heavy = sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if c * heavy <= budget * w]
        if not full:
            return out | {n: budget * w // heavy for n, (w, _) in open_.items()}
        first = min(full, key=lambda n: (open_[n][1] / open_[n][0], n))
        out[first] = open_.pop(first)[1]
        budget -= out[first]
    return out


def plain_mixture(rows, budget_of, max_epochs, seed):
    """Rows are (doc_id, path, weights, tokens)."""
    total = sum(r[3] for r in rows)
    leaves = defaultdict(int)
    weights = {}
    for _, path, w, tokens in rows:
        leaves[path] += tokens
        for i in range(len(path)):
            weights[path[: i + 1]] = w[i]

    def share(prefix, budget, out):
        if len(prefix) == 3:
            out[prefix] = budget
            return
        children = sorted({p[: len(prefix) + 1] for p in leaves if p[: len(prefix)] == prefix})
        listed = [
            (c, weights[c], max_epochs * sum(t for p, t in leaves.items() if p[: len(c)] == c))
            for c in children
        ]
        for child, given in plain_shares(budget, listed).items():
            share(child, given, out)

    budgets = {}
    share((), min(budget_of(total), max_epochs * total), budgets)
    out = Counter()
    for path, budget in budgets.items():
        mine = [r for r in rows if r[1] == path]
        whole, rest = divmod(budget, leaves[path]) if leaves[path] else (0, budget)
        spent, taken = 0, set()
        key = {r[0]: hashlib.md5(f"{seed}:{whole}:{'' if r[0] is None else r[0]}".encode()).hexdigest() for r in mine}
        for k in sorted(set(key.values())):
            spent += sum(r[3] for r in mine if key[r[0]] == k)
            if rest == 0 or spent > rest:
                break
            taken.add(k)
        for r in mine:
            for epoch in range(whole + (key[r[0]] in taken)):
                out[r[0], epoch, budget] += 1
    return out


def mixture_rows(df):
    def number(source):
        digits = "".join(c for c in (source or "") if c.isdigit())
        return int(digits) if digits else 0

    rows = []
    for r in df.select("doc_id", "text", "lang", "source").collect():
        n = number(r.source)
        tokens = (len((r.text or "").encode()) + 3) // 4
        path = (f"d{n % 4}", r.lang or "", r.source or "")
        rows.append((r.doc_id, path, (4 - n % 4, 5 if r.lang == "en" else 2, 1 + n % 3), tokens))
    return rows


@pytest.mark.parametrize("share, epochs", [(1.0, 2), (0.5, 1), (3.0, 2), (0.0, 2), (1.7, 4)])
def test_mixture_against_plain_budgets(spark, share, epochs):
    df = plain.frame(spark, plain.odd_texts(seed=7))
    got = mixed(df, mixture_levels(), F.floor(F.col("total") * share), epochs, seed=3)
    rows = Counter((r.doc.doc_id, r.epoch, r.budget) for r in got.collect())
    want = plain_mixture(mixture_rows(df), lambda t: int(t * share), epochs, 3)
    assert rows == want
    assert got.select("doc.*").columns == df.columns


def test_shortages_go_to_siblings_first(spark):
    rows = [(i, "x" * 400, "en", "src0") for i in range(10)]  # 1000 tokens
    rows += [(100 + i, "x" * 400, "de", "src0") for i in range(1)]  # 100 tokens, same domain
    rows += [(200 + i, "x" * 400, "en", "src1") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    levels = [
        ("domain", F.col("source"), F.lit(1)),
        ("lang", F.col("lang"), F.lit(1)),
        ("source", F.col("source"), F.lit(1)),
    ]
    got = mixed(df, levels, F.lit(1000), max_epochs=1)
    budgets = {(r.node_domain, r.node_lang): r.budget for r in got.select("node_domain", "node_lang", "budget").distinct().collect()}
    assert budgets == {("src0", "de"): 100, ("src0", "en"): 400, ("src1", "en"): 500}


def test_mixture_of_odd_tables(spark):
    assert mixed(plain.empty(spark), mixture_levels(), F.col("total")).collect() == []
    df = plain.frame(spark, [None, "", None], extra=False)
    assert mixed(df, mixture_levels(), F.col("total")).collect() == []


def test_a_hot_leaf_is_many_stretches(spark):
    rows = [(i, "x" * (i % 50), "en", "src0") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixed(df, mixture_levels(), F.floor(F.col("total") * 0.37))
    assert Counter((r.doc.doc_id, r.epoch, r.budget) for r in got.collect()) == plain_mixture(
        mixture_rows(df), lambda t: int(t * 0.37), 2, 1
    )


@pytest.mark.parametrize("n", [1, 2, 3, 8])
def test_shards_are_near_equal(spark, n):
    rng = random.Random(n)
    texts = ["y" * rng.randrange(1, 400) + str(i) for i in range(1500)]
    df = plain.frame(spark, texts)
    got = shards(df, shard_dims(), n_shards=n).collect()
    assert len(got) == df.count()
    size, slots = Counter(), defaultdict(list)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(size) == list(range(n))
    assert max(size.values()) - min(size.values()) <= 0.03 * sum(size.values()) / n + 800
    for listed in slots.values():
        assert sorted(listed) == list(range(len(listed)))


def test_shards_hold_sizes_and_digests(spark):
    texts = plain.odd_texts(seed=1)
    df = plain.frame(spark, texts)
    for r in shards(df, shard_dims(), target_bytes=4000).collect():
        if r.doc_id is not None:
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))


def test_cuts_follow_the_widest_dimension(spark):
    rows = [(i, "z" * 9 + str(i).zfill(4), "en" if i % 2 else "de") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    dims = [F.when(F.col("lang") == "en", 1.0).otherwise(0.0), F.col("doc_id") / 1000]
    got = shards(df, dims, n_shards=4)
    sides = got.join(df.select("doc_id", "lang"), "doc_id").groupBy("shard").agg(
        F.countDistinct("lang").alias("langs"),
        F.min("doc_id").alias("lo"),
        F.max("doc_id").alias("hi"),
    ).collect()
    assert all(r.langs == 1 for r in sides)
    halves = sorted((r.lo // 200, r.hi // 200) for r in sides)
    assert halves == [(0, 0), (0, 0), (1, 1), (1, 1)]


def test_copies_stay_together_unless_they_are_many(spark):
    texts = [f"text {i} " * 20 for i in range(300)] + ["copied three times " * 10] * 3
    df = plain.frame(spark, texts, extra=False)
    got = shards(df, shard_dims(), n_shards=4)
    where = {r.shard for r in got.collect() if r.doc_id >= 300}
    assert len(where) == 1
    many = plain.frame(spark, ["one"] * 500 + [f"text {i}" for i in range(500)], extra=False)
    size = Counter()
    for r in shards(many, shard_dims(), n_shards=8).collect():
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= 20


def test_shards_of_odd_tables(spark):
    assert shards(plain.empty(spark), shard_dims(), n_shards=8).collect() == []
    assert shards(plain.empty(spark), shard_dims(), target_bytes=10).collect() == []
    few = shards(plain.frame(spark, [None, None, "a"], False), shard_dims(), n_shards=8).collect()
    assert sorted(r.size for r in few) == [1, 1, 2]
    with pytest.raises(ValueError):
        shards(plain.empty(spark), shard_dims())


def test_native_operators_stay_in_the_jvm(spark):
    sf = "/root/testdata/sf0.001"
    df = plain.frame(spark, plain.odd_texts(seed=1, count=3))
    for got in (op2_sharding(spark, sf), mixed(df, mixture_levels(), F.col("total"))):
        assert "Python" not in got._jdf.queryExecution().toString()


def test_cuts_read_the_points_once(spark, monkeypatch):
    """Histograms read stored keys; points are not joined to their nodes for each."""
    plans = []
    stored = sharding.stored

    def planned(df, *args, **more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, *args, **more)

    monkeypatch.setattr(sharding, "stored", planned)
    shards(plain.frame(spark, plain.odd_texts(), False), shard_dims(), n_shards=4).collect()
    reads = [sum("Relation" in x and "tie#" in x for x in p.splitlines()) for p in plans]
    assert max(reads) == 1

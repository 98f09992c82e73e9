"""Jaccard join, components, repeated strings and decontamination."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from whosaid.llm import decontaminate, jaccard_join, segments, suffix_dedup
from whosaid.llm.components import components
from whosaid.llm.jaccard_join import jaccard_components
from whosaid.llm.suffix_dedup import remove_repeats


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_join_against_all_pairs(spark, k, percent):
    texts = plain.odd_texts(seed=k)
    got = jaccard_components(plain.frame(spark, texts), k, percent, segment_bytes=2000)
    sets = {i: plain.shingles(t, k) for i, t in enumerate(texts)}
    want = plain.components(sets, percent)
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()]
    expected = [(i, len(sets[i]), want[i]) for i in sets]
    copies = [expected[-2], expected[3]]
    assert Counter(r for r in rows if r[0] is not None) == Counter(expected + copies)
    assert [r[2] for r in rows if r[0] is None] == [None]


def test_members_of_a_hot_signature_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MEETING", 10)
    rows = [(sig, (i,)) for sig, n in ((1, 95), (2, 1), (3, 2)) for i in range(n)]
    members = spark.createDataFrame(rows, "sig long, m struct<node:long>")
    met = jaccard_join._met(members)
    got = [(r.sig, r.p.node, r.q.node) for r in met.select("sig", "p", "q").collect()]
    want = [(1, a, b) for a in range(95) for b in range(a + 1, 95)] + [(3, 0, 1)]
    assert sorted(got) == want
    most = met.groupBy("sig", "i", "j").count().agg(F.max("count")).first()[0]
    assert most < 95 * 94 // 2 // 10

    # Sets that share signatures of empty cells only: many, and in no component.
    texts = [f"x{i} y{i} z{i} v{i}" for i in range(60)] + ["x1 y1 z1 v1 u1"]
    df = plain.frame(spark, texts, extra=False)
    components_ = {r.doc_id: r.component_id for r in jaccard_components(df, 1, 80).collect()}
    assert components_ == {i: 1 if i == 60 else i for i in range(61)}


@pytest.mark.parametrize("meeting", [3, 500])
def test_links_against_all_pairs(spark, monkeypatch, meeting):
    monkeypatch.setattr(jaccard_join, "MEETING", meeting)
    texts = plain.odd_texts(seed=5, count=25)
    base = [f"b{i}" for i in range(60)]
    texts += [" ".join([*base[:i], "new", *base[i + 1 :]]) for i in range(12)]
    other = spark.createDataFrame([(10, " ".join(base))], "doc_id long, text string")
    df = plain.frame(spark, texts).select("doc_id", "text").union(other)
    got = jaccard_join.jaccard_degrees(df, 3, 80, segment_bytes=2000).collect()
    rows = [(r.doc_id, plain.shingles(r.text, 3)) for r in df.collect()]

    def near(s, t):
        return bool(s & t) and 100 * len(s & t) >= 80 * len(s | t)

    want = Counter(
        (i, len(s), None if i is None else sum(near(s, t) for j, t in rows if j is not None) - bool(s))
        for i, s in rows
    )
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in got) == want
    assert max(r.n_links or 0 for r in got) >= 12
    same = jaccard_components(df, 3, 80, segment_bytes=2000).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(map(tuple, same))


def test_jaccard_join_at_the_threshold(spark):
    # 19 of 21 is above nine tenths, 18 of 20 equals it, 17 of 19 is below.
    texts = []
    for same in (19, 18, 17):
        base = [f"{same}-{i}" for i in range(same)]
        texts += [" ".join([*base, "p"]), " ".join([*base, "q"])]
    got = {r.doc_id: r.component_id for r in jaccard_components(
        plain.frame(spark, texts, extra=False), k=1, percent=90
    ).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5}


def test_a_large_group_of_near_copies_is_whole(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    texts = []
    for _ in range(120):
        words = list(base)
        for i in rng.sample(range(100), rng.randrange(0, 14)):
            words[i] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    got = {r.doc_id: r.component_id for r in jaccard_components(
        plain.frame(spark, texts, extra=False), k=1, percent=90, segment_bytes=3000
    ).collect()}
    assert got == plain.components({i: plain.shingles(t, 1) for i, t in enumerate(texts)}, 90)


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    cache = {}
    for _ in range(600):
        union = int(rng.integers(1, 200))
        s = np.unique(rng.integers(0, 2**64, union, dtype=np.uint64))
        common = -(-percent * len(s) // 100)
        odd = len(s) - common
        split = int(rng.integers(0, odd + 1))
        order = rng.permutation(len(s))
        a = np.sort(np.concatenate([s[order[:common]], s[order[common : common + split]]]))
        b = np.sort(np.concatenate([s[order[:common]], s[order[common + split :]]]))
        if len(a) and len(b):
            x = jaccard_join.signatures(a, percent, cache)
            y = jaccard_join.signatures(b, percent, cache)
            assert np.intersect1d(x, y).size


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(3)
    for _ in range(200):
        s = np.unique(rng.integers(0, 2**64, 300, dtype=np.uint64))
        a, b = s[rng.random(len(s)) < 0.9], s[rng.random(len(s)) < 0.9]
        bits = sum(
            bin((x ^ y) & (2**64 - 1)).count("1")
            for x, y in zip(jaccard_join.sketch(a), jaccard_join.sketch(b))
        )
        assert bits <= len(np.setxor1d(a, b))


def test_wide_sketches_of_sets_of_any_size():
    rng = np.random.default_rng(4)
    for n, m in ((1, 3), (100, 100), (100, 900), (3000, 2500), (5, 4000)):
        s = np.unique(rng.integers(0, 2**64, n + m, dtype=np.uint64))
        a, b = s[:n], s[n // 2 :]
        distance = jaccard_join.sketch_distance(
            jaccard_join.wide_sketch(a), jaccard_join.wide_sketch(b)
        )
        assert distance <= len(np.setxor1d(a, b))
        same = jaccard_join.sketch_distance(
            jaccard_join.wide_sketch(a), jaccard_join.wide_sketch(a)
        )
        assert same == 0 and (distance > 0 or n == 1)


def test_words_of_very_long_texts_are_those_of_the_whole(monkeypatch):
    texts = [t.encode() for t in plain.odd_texts(seed=9) if t]
    whole = jaccard_join.word_hashes(texts)
    monkeypatch.setattr(jaccard_join, "PIECE", 50)
    parts = jaccard_join.word_hashes(texts)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_components_of_odd_graphs(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)]
    links += [(rng.randrange(200, 280), rng.randrange(200, 280)) for _ in range(50)]
    links += [(300, 300), (301, None), links[0]]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(links, "a long, b long")
    ).collect()}
    root = {}

    def find(i):
        root.setdefault(i, i)
        return i if root[i] == i else find(root[i])

    for a, b in links:
        if b is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {i: find(i) for i in list(root)}


def test_pair_operators_on_empty_tables(spark):
    none = plain.empty(spark)
    assert jaccard_components(none).collect() == []
    assert remove_repeats(none).collect() == []
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(none, items).collect() == []
    got = decontaminate.contamination(plain.frame(spark, ["a b c"], False), items.limit(0))
    assert [(r.n_words, r.n_hit, r.items) for r in got.collect()] == [(3, 0, [])]


def test_packed_runs_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (segments.unpack(segments.pack(keys), len(keys)) == keys).all()
        at = segments.cuts(keys, 7)
        assert at[0] == 0 and at[-1] == len(keys) and (np.diff(at) >= 0).all()


def test_cover_has_every_difference():
    d = {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER}
    assert d == set(range(suffix_dedup.PERIOD))


def repeats_agree(spark, texts, length, **options):
    got = remove_repeats(plain.frame(spark, texts, extra=False), length, **options)
    want = plain.removed_bytes([(t or "").encode() for t in texts], length)
    for row in got.collect():
        text, covered = (texts[row.doc_id] or "").encode(), want[row.doc_id]
        kept = bytes(b for b, c in zip(text, covered) if not c)
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        assert bytes(row.kept) == kept and len(row.spans) == spans
        assert sum(s.end - s.start for s in row.spans) == sum(covered)
        assert row.n_bytes == len(text)


def test_repeats_against_all_windows(spark):
    texts = plain.odd_texts(seed=4)
    passage = "p q r s t u v é " * 12
    texts += [f"{i} " * i + passage + f" {i}" * 3 for i in range(12)]
    texts += ["ab" * 150, "x" + "ab" * 120, "y" * 199, "y" * 200, "z" * 201, "z" * 199]
    for length in (74, 200):
        repeats_agree(spark, texts, length, segment_bytes=3000)


def test_repeats_across_blocks_of_a_long_text(spark, monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice("abc") for _ in range(3000))
    texts = [text, text[500:1900] + "-" + text[100:320], text[900:1120]]
    monkeypatch.setattr(suffix_dedup, "BLOCK", 256)
    blocks = list(suffix_dedup.pieces([t.encode() for t in texts], 200))
    assert len(blocks) > 10
    repeats_agree(spark, texts, 200)


def test_repeated_tails_of_texts_that_end_behind_a_block(spark, monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 256)
    texts = []
    for blocks in (1, 2):
        for rest in (127, 128, 151, 175, 199, 200):
            for tail in (200, 235, 270):
                n = blocks * 256 + rest
                text = "".join(rng.choice("abcdefgh") for _ in range(n))
                before = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(300)))
                texts += [text, before + text[-tail:]]
    repeats_agree(spark, texts, 200, segment_bytes=20_000)


def test_repeated_rows_are_repeats(spark):
    df = plain.frame(spark, ["a" * 20 + str(i) * 300 for i in range(5)])
    rows = remove_repeats(df).select("doc_id", F.octet_length("kept").alias("n")).collect()
    assert Counter((r.doc_id, r.n) for r in rows)[(3, 0)] == 3


def test_contamination_against_plain_search(spark):
    rng = random.Random(8)
    texts = plain.odd_texts(seed=8)
    items = [(i, t) for i, t in enumerate(texts[12:20])]
    items += [(50, "w1 w2"), (51, "w3"), (52, ""), (53, None), (None, "w4 w5"), (54, "W1, w2!")]
    items += [(55, texts[13])]
    for i in range(8):
        words = (items[i][1] or "x").split(" ")
        start = rng.randrange(len(words))
        texts.append("zz " + " ".join(words[start : start + 15]) + " zz")
    df = plain.frame(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1))
    for window in (10, 3):
        want = plain.contamination(texts, items, window)
        got = decontaminate.contamination(df, bench, window).collect()
        assert len(got) == df.count()
        for r in got:
            if r.doc_id is not None:
                assert (r.n_words, r.n_hit, r.items) == want[r.doc_id]


def test_contamination_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_TERMS", 0)
    texts, items = ["a b c d e", "x b c d y", None], [(1, "b c d"), (2, "e"), (3, "q q")]
    got = decontaminate.contamination(
        plain.frame(spark, texts, False),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert sorted((r.doc_id, r.n_hit, r.items) for r in got.collect()) == [
        (0, 4, ["1", "2"]), (1, 3, ["1"]), (2, 0, []),
    ]


def test_proximity(spark):
    texts = ["a x b", "b x x x a", "a b a", "b q a"]
    index, windows, _ = decontaminate.indexed(
        plain.frame(spark, texts, False),
        spark.createDataFrame([(1, "a"), (2, "b")], "item_id long, text string"),
    )
    both = windows.withColumn("window", F.lit(0))
    got = decontaminate.proximity_matches(index, both, 3)
    docs = index.where("term = -1").select("row", "doc_id")
    rows = got.join(docs, "row").select("doc_id", "start", "end").collect()
    assert sorted(map(tuple, rows)) == [(0, 0, 3), (2, 0, 2), (2, 1, 3), (3, 0, 3)]


def test_proximity_of_windows_of_several_words(spark):
    texts = ["a b c", "a b x c", "b a c", "c q b a", "a b x x x c", "a b", "z z a b x c a b c", None]
    df = plain.frame(spark, texts, False)
    items = [(1, "a b c"), (2, "b b a"), (3, "c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_near, r.items) for r in decontaminate.near_passages(df, bench, 10, 4).collect()}

    def stretches(words, wanted):
        ends = set()
        for end in range(1, len(words) + 1):
            if words[end - 1] in wanted and wanted <= set(words[max(0, end - 4) : end]):
                ends.add(end)
        return len(ends)

    for i, text in enumerate(texts):
        n = {k: stretches((text or "").split(), set(t.split())) for k, t in items}
        assert got[i] == (sum(n.values()), [str(k) for k in sorted(n) if n[k]]), text
    assert got[1][1] == got[2][1] == ["1", "2", "3"] and got[4][1] == ["2", "3"]


def test_decontamination_stays_in_the_jvm(spark):
    found = decontaminate.contamination(
        plain.frame(spark, ["a b"], False),
        spark.createDataFrame([(1, "a b")], "item_id long, text string"),
    )
    assert "Python" not in found._jdf.queryExecution().toString()


def near_copies(seed, bases=2, count=60, words=100):
    """Words of copies of some texts, with none to many words changed, often alike."""
    rng = random.Random(seed)
    texts = []
    for base in range(bases):
        first = [f"b{i}" if i % 3 else f"b{base}-{i}" for i in range(words)]
        for _ in range(count):
            copy = list(first)
            for i in rng.sample(range(words), rng.randrange(0, words // 4)):
                copy[i] = f"e{rng.randrange(40 * words)}" if rng.random() < 0.8 else f"e{i}"
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("few, k, percent", [(1, 3, 60), (4, 1, 90), (2, 2, 100)])
def test_components_by_differences_from_pivots(spark, monkeypatch, few, k, percent):
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "KEYS", 300)
    texts = plain.odd_texts(seed=few, count=15) + near_copies(seed=few + k)
    got = {r.doc_id: r.component_id for r in jaccard_components(
        plain.frame(spark, texts, extra=False), k, percent, segment_bytes=4000
    ).collect()}
    sets = {i: plain.shingles(t, k) for i, t in enumerate(texts)}
    assert got == plain.components(sets, percent)


@pytest.mark.parametrize("percent", [60, 80, 90, 100])
def test_linked_sets_share_a_key_of_their_differences(percent):
    rng = np.random.default_rng(percent)
    checked = 0
    for _ in range(300):
        size = int(rng.integers(1, 80))
        pool = np.unique(rng.integers(0, 1 << 64, 3 * size, dtype=np.uint64))
        base = rng.permutation(pool)[:size]

        def changed(base, n):
            kept = rng.permutation(base)[n // 2 :]
            return np.unique(np.concatenate([kept, rng.permutation(pool)[: n - n // 2]]))

        far = changed(base, int(rng.integers(0, size + 1)))
        pivot, x = np.sort(base), changed(far, int(rng.integers(0, 4)))
        y = changed(far, int(rng.integers(0, 1 + size // 4)))

        def linked(s, t):
            both = len(np.intersect1d(s, t))
            return 100 * both >= percent * (len(s) + len(t) - both)

        if not len(x) or not len(y) or not linked(x, y) or linked(x, pivot) and linked(y, pivot):
            continue
        checked += 1
        (kx, nx, _), (ky, ny, _) = (
            jaccard_join.difference_keys(pivot, s, percent) for s in (x, y)
        )
        kx, ky = (
            keys[:n] if linked(s, pivot) or not linked(other, pivot) else keys
            for keys, n, s, other in ((kx, nx, x, y), (ky, ny, y, x))
        )
        assert len(np.intersect1d(kx, ky))
    assert checked > 10


def test_pairs_of_near_copies_are_not_all_listed(spark, monkeypatch):
    """Texts that share signatures, many in one component and many in none."""
    rows = []
    met_ = jaccard_join._met

    def met(members):
        out = met_(members)
        if "at" in members.schema["m"].dataType.names:
            out = out.where(jaccard_join._meets(90))
        else:
            out = out.where("p.c <> q.c")
        rows.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "_met", met)
    listed = {}
    for count in (100, 300):
        texts = near_copies(seed=7, bases=1, count=count, words=200)
        got = {r.doc_id: r.component_id for r in jaccard_components(
            plain.frame(spark, texts, extra=False), k=1, percent=90
        ).collect()}
        sets = {i: plain.shingles(t, 1) for i, t in enumerate(texts)}
        assert got == plain.components(sets, 90)
        listed[count] = rows.pop()
    assert listed[300] < 6 * max(listed[100], 300), listed


def test_elements_that_no_other_set_has(spark):
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 64, 400, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, n)) for n in rng.integers(1, 60, 50)]
    times = Counter(e for s in sets for e in s.tolist())
    rows = [(i - 25, len(s), bytearray(s.tobytes())) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "key long, size long, elements binary").repartition(3)
    want = {i - 25: sum(times[e] == 1 for e in s.tolist()) for i, s in enumerate(sets)}
    assert any(want.values())
    for segment_bytes in (500, 1 << 20):
        got = segments.unshared(df, segment_bytes).collect()
        assert len(got) == len({r.key for r in got}) == len(sets)
        assert {r.key: r.own for r in got} == want
    assert segments.unshared(df.limit(0), 500).collect() == []


def test_texts_that_only_share_a_passage_do_not_meet(spark, monkeypatch):
    """Most signatures of theirs are of the passage, and no pair of them is compared."""
    near_, compared = jaccard_join._near, []

    def near(pairs, texts, percent):
        compared.append(pairs.count())
        return near_(pairs, texts, percent)

    monkeypatch.setattr(jaccard_join, "_near", near)
    passage = [f"p{i}" for i in range(15)]
    texts = [" ".join([f"w{i}-{j}" for j in range(45)] + passage) for i in range(80)]
    texts += [" ".join([texts[0].rpartition(" ")[0], "other"])]
    got = {r.doc_id: r.component_id for r in jaccard_components(
        plain.frame(spark, texts, extra=False), k=1, percent=80
    ).collect()}
    assert got == {i: 0 if i == 80 else i for i in range(81)}
    assert sum(compared) == 1


def test_signatures_of_a_family_have_one_pivot(spark):
    signed = {9: (1, 2, 3), 1: (1, 4), 2: (2, 4), 3: (3, 4), 7: (5,), 8: (5,)}
    rows = [(sig, node, 0) for node, sigs in signed.items() for sig in sigs]
    members = spark.createDataFrame(rows, "sig long, node long, c long")
    got = {r.sig: r.pivot.node for r in jaccard_join._pivots(members).collect()}
    assert got == {1: 9, 2: 9, 3: 9, 4: 9, 5: 8}

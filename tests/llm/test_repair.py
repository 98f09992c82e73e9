"""Operator 11 against a search over whole strings of edits."""

import collections
import hashlib
import itertools
import random
import re

import pytest

from whosaid.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, seg int, kind int, part int, first string"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def ordered(rows):
    def key(r):
        return (r[0] is not None, r[0] or 0, r[1] or "", hashlib.sha256((r[2] or "").encode()).digest())

    return sorted(rows, key=key)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = (text or "").strip(" \t\n\x0b\f\r")
        if not body:
            out.append("blank")
        elif (role or "", text or "") in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role or "", text or ""))
    return out


def search(rows, found):
    """The least (cost, audit) with its turns, over all edits of each row."""
    best = {"": (0, "", ())}

    def offer(table, state, made):
        if state not in table or made[:2] < table[state][:2]:
            table[state] = made

    def inserts(table):
        for _ in range(3):
            for state, (cost, audit, turns) in list(table.items()):
                for r in "ua":
                    if (state, r) in NEXT:
                        offer(table, NEXT[state, r], (cost + 5, audit + "I", turns + ((NAMES[r], ""),)))

    for (_, role, text), fault in zip(rows, found):
        inserts(best)
        after = {}
        extra = 5 if fault == "truncated" else 0
        for state, (cost, audit, turns) in best.items():
            offer(after, state, (cost + 2, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            first = (role or "")[:1]
            if (state, first) in NEXT:
                offer(after, NEXT[state, first], (cost + extra, audit + "K", turns + ((role, text),)))
            for r in "ua":
                if (state, r) in NEXT:
                    made = (cost + extra + 1, audit + "R", turns + ((NAMES[r], text),))
                    offer(after, NEXT[state, r], made)
        best = after
    inserts(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])


def brute(rows):
    groups = collections.defaultdict(list)
    for conv_id, *row in rows:
        groups[conv_id].append(tuple(row))
    out = {}
    for conv_id, own in groups.items():
        own = ordered(own)
        found = faults(own)
        cost, audit, turns = search(own, found)
        known = {t for t, _, _ in own if t is not None}
        pairs = zip(own, own[1:])
        illegal = sum((a[1] or "")[:1] + (b[1] or "")[:1] not in ("su", "ua", "au") for a, b in pairs)
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        lines = "\n".join(f"{r}:{t}" for r, t in turns)
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv_id] = (
            gaps, *counts, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest()
        )
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in turns))
    return out


def sample(rng, conversations, length):
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "ux"]
    texts = ["Yes.", "No", "Is it?", "", " \x0b", None, "Well!  ", "a", "b", "é."]
    rows = []
    for conv_id in range(conversations):
        for turn in range(rng.randrange(length)):
            shown = None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 1, 7])
            text = rng.choice(texts) if rng.random() < 0.6 else f"t{turn}."
            rows.append((conv_id if conv_id else None, shown, rng.choice(roles), text))
            if rng.random() < 0.1:
                rows += [rows[-1]] * rng.choice([1, 4])
    return rows


def check(spark, rows, monkeypatch=None):
    df = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_report(df).collect()}
    want = brute(rows)
    assert got == want
    return df, want


def test_against_a_plain_search(spark):
    rows = sample(random.Random(1), 60, 14)
    df, want = check(spark, rows)
    reports, turns = repair.repair_conversations(df)
    found = collections.defaultdict(list)
    for r in sorted(turns.collect(), key=lambda r: r.turn):
        found[r.conv_id].append(f"{r.role}:{r.text}")
    for r in reports.collect():
        lines = "\n".join(found[r.conv_id])
        assert hashlib.sha256(lines.encode()).hexdigest() == want[r.conv_id][-1]


def test_a_conversation_of_many_pieces_and_parts(spark):
    rng = random.Random(2)
    rows = [
        (7, turn, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "b", f"{turn}!", ""]))
        for turn in range(9000)
    ]
    rows += [(8, 1, "user", "Same.")] * 5000 + sample(rng, 20, 6)
    check(spark, rows)


@pytest.mark.parametrize("prime", [1, 7, (1 << 61) - 1])
def test_order_of_paths_with_hashes_that_collide(prime):
    rng = random.Random(3)
    paths = repair.Paths(prime)
    nodes = {"": 0}
    for _ in range(300):
        edits = rng.choice(list(nodes))[: rng.randrange(40)]
        while edits not in nodes:
            edits = edits[:-1]
        parent = nodes[edits]
        for letter in rng.choices("DIK", k=rng.randrange(1, 6)):
            parent, edits = paths.add(parent, letter), edits + letter
            nodes[edits] = parent
    listed = list(nodes.items())
    # Nodes of the same edits on another way.
    for edits in rng.sample(list(nodes), 60):
        node = 0
        for letter in edits:
            node = paths.add(node, letter)
        listed.append((edits, node))
    for (a, x), (b, y) in rng.sample(list(itertools.product(listed, listed)), 4000):
        assert paths.edits(x) == a
        for p, q in ("DK", "KI", "II"):
            assert paths.less(x, p, y, q) == (a + p < b + q), (a, p, b, q)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(df).collect() == []
    ids = spark.createDataFrame([(3,), (None,), (3,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_report(df, ids).collect()}
    assert got == {3: nothing, None: nothing}


def test_columns_of_the_report(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(df).columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256",
    ]

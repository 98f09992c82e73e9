"""Fingerprints, token counts, licenses, quality and chats."""

import json
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm import plain
from whosaid.llm import chat, fingerprints, licenses, quality, token_counts
from whosaid.llm.queries import VOCABULARY, op7_quality


def test_fingerprints_against_plain_neighbours(spark):
    texts = [t or "" for t in plain.odd_texts(seed=3)]
    for range_rows in (7, 1000):
        got = fingerprints.fingerprints(plain.frame(spark, texts, False), range_rows).collect()
        assert len(got) == len(texts)
        for r in got:
            text, following = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
            half = len(text) // 2
            edit = text[: len(text) - half] + following[:half]
            chunks = [fingerprints.fingerprint(t.encode()) for t in (text, edit, following)]
            assert (r.n_chars, r.edited) == (len(text), edit)
            assert r.fingerprint == fingerprints.spelled(chunks[0])
            assert r.edited_fingerprint == fingerprints.spelled(chunks[1])
            assert r.near_edited == fingerprints.containment(chunks[0], chunks[1])
            assert r.near_next == fingerprints.containment(chunks[0], chunks[2])


def test_fingerprints_of_odd_tables(spark):
    assert fingerprints.fingerprints(plain.empty(spark)).collect() == []
    df = plain.frame(spark, plain.odd_texts(seed=3))
    rows = fingerprints.fingerprints(df, 5).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in df.collect())
    alone = fingerprints.fingerprints(plain.frame(spark, ["a b c d " * 40], False)).first()
    assert alone.near_next == 1.0


def test_chunks_cover_the_text_and_survive_a_shift(monkeypatch):
    rng = random.Random(1)
    text = bytes(rng.randrange(97, 110) for _ in range(20_000))
    ends = fingerprints.chunk_ends(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes.max() <= fingerprints.LARGEST
    assert (sizes[:-1] >= fingerprints.SMALLEST).all()
    shifted = fingerprints.fingerprint(b"inserted" + text)
    assert fingerprints.containment(fingerprints.fingerprint(text), shifted) > 0.98
    monkeypatch.setattr(fingerprints, "PIECE", 100)
    assert fingerprints.chunk_ends(text) == ends
    assert fingerprints.chunk_ends(b"") == []


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.read_vocabulary(VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    """The same vocabulary in the library's own unigram tokenizer."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(VOCABULARY, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    scores = dict(vocabulary.pieces)
    for piece in model.pieces:
        piece.score = scores.get(piece.piece, piece.score)
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_token_counts_equal_the_tokenizer(vocabulary, tokenizer):
    counter = token_counts.Counter(vocabulary)
    rng = random.Random(1)
    alphabet = " abtheé漢字\n.,▁('<>0x\t😀|!"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(4000)]
    texts += [t for t in plain.odd_texts(seed=2, count=10) if t]
    for text in texts:
        assert counter.count(text)[0] == len(tokenizer.encode(text)), text


def test_ties_and_unknown_characters():
    pieces = (("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abc", -4.0), ("c", -2.0))
    counter = token_counts.Counter(token_counts.Vocabulary(pieces, False, False))
    assert counter.path("ab") == (1, -2.0)
    assert counter.path("abc") == (1, -4.0)
    # Unknown characters side by side are one piece without byte pieces.
    assert counter.count("xyab")[0] == 2
    assert token_counts.Counter(
        token_counts.Vocabulary(pieces, True, False)
    ).count("éab")[0] == 3


def test_token_counts_of_odd_tables(spark, vocabulary):
    texts = plain.odd_texts(seed=2, count=5)
    df = plain.frame(spark, texts)
    got = token_counts.token_counts(df, vocabulary).collect()
    counter = token_counts.Counter(vocabulary)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_tokens, r.best_score) == counter.count(texts[r.doc_id] or "")
    assert len(got) == df.count()
    assert token_counts.token_counts(plain.empty(spark), vocabulary).collect() == []


def lcs(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(rows[-1][j] + 1 if x == y else max(rows[-1][j + 1], row[j]))
        rows.append(row)
    return rows[-1][-1]


def test_alignment_against_all_pairs():
    rng = random.Random(3)
    for _ in range(200):
        template = [rng.randrange(1, 9) for _ in range(rng.randrange(3, 15))]
        gone = {rng.randrange(len(template)) for _ in range(3)}
        words = [0] * 4 + [w for i, w in enumerate(template) if i not in gone] + [0] * 4
        pairs = licenses.aligned(template, words, 4)
        assert all(template[i] == words[j] and abs(j - 4 - i) <= 4 for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
        assert len(pairs) >= len(template) - len(gone)
        assert len(pairs) <= lcs(template, words)


def test_licenses_are_found_with_their_spans(spark):
    notice = licenses.TEMPLATES["GPL-3.0 notice"]
    grant = licenses.TEMPLATES["MIT grant"]
    changed = grant.replace("free of charge", "at no charge")
    texts = [
        f"w1 {notice} w2", "İ İ " + notice, f"{grant}\n{grant}", changed, notice[: len(notice) // 2],
        "this work is", None, "", "licensed under the", notice.upper(),
    ]
    got = licenses.license_matches(plain.frame(spark, texts, False)).collect()
    found = {}
    for r in got:
        assert 0.8 <= r.coverage <= 1
        found.setdefault(r.doc_id, []).append((r.license, texts[r.doc_id][r.start : r.end]))
    assert found[0] == found[1] == [("GPL-3.0 notice", notice[:-1])]
    assert [f[0] for f in found[2]] == ["MIT grant"] * 2
    assert [f[0] for f in found[3]] == ["MIT grant"] and found[3][0][1] == changed
    assert [f[0] for f in found[9]] == ["GPL-3.0 notice"]
    assert set(found) == {0, 1, 2, 3, 9}
    assert licenses.license_matches(plain.empty(spark)).collect() == []
    with pytest.raises(ValueError):
        licenses.build_index({"short": "a b"})


NEAR = {
    "Licensed under CC BY 4.0.": "CC-BY-4.0 short notice",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0 notice",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0 notice",
    "Licensed under CC BY-NC-SA 3.0.": "CC-BY-NC-SA-3.0 notice",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
    "License.": "CC-BY-NC-4.0 long notice",
    "This work is licensed under a Creative Commons Attribution-Non-Commercial 4.0 International "
    "License.": "CC-BY-NC-4.0 long notice",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0 notice",
    "This work is licensed under the GNU General Public License, version 3.0.": "GPL-3.0 notice",
    "This work is licensed under the GNU General Public License v3.": "GPL-3.0 notice",
    "This work is licensed under the GNU General Public License, version 3.1.": "GPL notice",
    "This work is licensed under the GNU Lesser General Public License, version 3.":
        "LGPL-3.0 notice",
    "This work is licensed under the GNU Lesser General Public License, version 2.1.":
        "LGPL-2.1 notice",
    "This work is licensed under the GNU Affero General Public License, version 3.":
        "AGPL-3.0 notice",
    "Released under the BSD License.": "BSD notice",
    "Released under the BSD 3-Clause License.": "BSD-3-Clause notice",
    "Released under the MIT License.": "MIT notice",
    "Licensed under the Apache License 2.0.": "Apache-2.0 notice",
    "Licensed under the Apache License, Version 1.1.": "Apache-1.1 notice",
    "All rights reserved.": "All rights reserved",
    "Released under the Foo License.": None,
    "Licensed under CC BY-XX 4.0.": None,
}


def test_near_variants_are_told_apart():
    index = licenses.build_index(licenses.TEMPLATES, licenses.MARKS)
    for text, name in NEAR.items():
        for around in (text, f"w1 w2. {text} w3 4 w5"):
            got = licenses.find_licenses(around, index, licenses.COVERAGE)
            assert [m[0] for m in got] == [name] * (name is not None), (around, got)


def test_every_template_finds_itself():
    index = licenses.build_index(licenses.TEMPLATES, licenses.MARKS)
    for name, text in licenses.TEMPLATES.items():
        got = licenses.find_licenses(f"w1 {text} w2", index, licenses.COVERAGE)
        assert [(m[0], m[1]) for m in got] == [(name, 1.0)], (name, got)


def test_every_long_shared_run_hits_the_index():
    index = licenses.build_index(licenses.TEMPLATES)
    for template in index.templates:
        words = np.array(template)
        keys = licenses._gram_keys(words, len(index.numbers) + 1)
        run = licenses.WINDOW
        for start in range(len(keys) - run + 1):
            assert np.isin(keys[start : start + run], index.grams).any()


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = op7_quality(spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality_density_against_plain_algebra(spark):
    rng = np.random.default_rng(1)
    d = len(quality.FEATURES)
    x = rng.normal(size=(400, d)) @ rng.normal(size=(d, d)) + 3
    y = (rng.random(400) < 0.6).astype(int)
    x[y == 1] += 0.5
    rows = spark.createDataFrame([(r.tolist(), int(c)) for r, c in zip(x, y)], "x array<double>, label int")
    model = quality.fit(rows, shrinkage=0.1, pooled=0.3)
    common = sum(np.cov(x[y == c].T) * ((y == c).sum() - 1) for c in (0, 1)) / 398
    logs = []
    for c in (0, 1):
        s = 0.7 * np.cov(x[y == c].T) + 0.3 * common
        s = 0.9 * s + 0.1 * (np.diag(np.diag(s) + 1e-6))
        z = x - x[y == c].mean(axis=0)
        logs.append(
            np.log((y == c).mean()) - np.linalg.slogdet(s)[1] / 2
            - np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z) / 2
        )
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)
    assert quality.Discriminant.from_json(model.to_json()) == model


def test_quality_of_odd_tables(spark):
    df = plain.frame(spark, plain.odd_texts(seed=2, count=5))
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(12)] + [(3, 1, 0), (4, None, 0), (None, 1, 1), (10**6, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    statistics = quality.measured(df, ["doc_id"])
    model = quality.train(statistics, labels)
    again = quality.scored_statistics(statistics, model).collect()
    got = quality.scored(df, model, ["doc_id", "size"]).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    assert sorted(r.score for r in again) == sorted(r.score for r in got)
    none = quality.train(statistics, labels.limit(0))
    assert {r.score for r in quality.scored(df, none, ["doc_id"]).collect()} == {0.5}
    assert quality.scored(plain.empty(spark), model, ["doc_id"]).collect() == []


def test_escapes_round_trip_and_hide_controls():
    rng = random.Random(2)
    parts = ["\\", "<", "|", "turn", "|>", "a", "\n", "é", *chat.CONTROL]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(8))
        assert chat.unescaped(chat.escaped(text)) == text
        assert not any(c in chat.escaped(text) for c in chat.CONTROL)


LAYOUTS = {
    '{"prompt": "p", "completion": "c"}': [("user", "p"), ("assistant", "c")],
    '{"system": "s", "instruction": "i", "input": null, "output": "o"}':
        [("system", "s"), ("user", "i"), ("assistant", "o")],
    '{"instruction": "i", "input": "x", "output": "o"}':
        [("user", "i"), ("user", "x"), ("assistant", "o")],
    '{"question": "q", "answer": 4}': [("user", "q"), ("assistant", "4")],
    '{"messages": [{"role": "user", "content": "u"}, {"content": "a", "role": "assistant"}]}':
        [("user", "u"), ("assistant", "a")],
    '{"conversations": [{"from": "human", "value": "u"}, {"from": "gpt", "value": null}]}':
        [("user", "u"), ("assistant", "")],
    '{"messages": []}': [],
    '{"role": "user", "content": "u"}': [("user", "u")],
    '{"message": {"author": {"role": "tool"}, "content": {"text": "t"}}}': [("tool", "t")],
}


def test_layouts_become_turns(spark):
    records = list(LAYOUTS)
    odd = [None, "no json", '{"unknown": 1}', "[]"]
    df = spark.createDataFrame(list(enumerate(records + odd)), "conv_id long, record string")
    df = df.withColumn("turn", F.lit(0)).withColumn("role", F.lit("clash"))
    got = chat.canonical_turns(df, ["conv_id", "turn"]).orderBy("conv_id", "part").collect()
    for i, record in enumerate(records):
        assert [(r.role, r.text) for r in got if r.conv_id == i] == LAYOUTS[record]
    for i in range(len(records), len(records) + len(odd)):
        assert [(r.role, r.text) for r in got if r.conv_id == i] == [(None, None)]


def test_optional_keys_and_unread_records(spark):
    records = [
        ('{"id": 7, "prompt": "p", "completion": "c", "metadata": {"a": [1]}}', [("user", "p"), ("assistant", "c")]),
        ('{"messages": [{"role": "user", "content": "u"}, {"role": "bot", "content": "a", "weight": 0}]}',
         [("user", "u"), ("assistant", "a")]),
        ('{"prompt": "p", "completion": "c", "rejected": "r"}', None),
        ('{"messages": ["u", "a"]}', None),
        ('{"messages": [{"role": "user", "content": "u"}, "a"]}', None),
        ("no json", None),
    ]
    df = spark.createDataFrame(
        [(i, 0, r) for i, (r, _) in enumerate(records)], "conv_id long, turn long, record string"
    )
    turns = chat.canonical_turns(df, ["conv_id", "turn"])
    got = turns.orderBy("conv_id", "part").collect()
    for i, (record, want) in enumerate(records):
        rows = [(r.role, r.text, r.unread) for r in got if r.conv_id == i]
        assert rows == ([(*w, None) for w in want] if want else [(None, None, record)])
    with pytest.raises(Exception, match="no known layout"):
        chat.format_chats(turns).collect()
    assert len(chat.format_chats(turns.where("unread is null")).collect()) == 2


def test_conversations_are_dealt_to_all_layouts(spark):
    shapes = ["ua", "sua", "uua", "suua", "uaua", "a", "u" * 70 + "a"]
    names = {"u": "user", "s": "system", "a": "assistant"}
    rows = [
        (6 * n + kind, t, names[c], f"{n} {t} <|end|>")
        for n, shape in enumerate(shapes) for kind in range(6) for t, c in enumerate(shape)
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.canonical_turns(chat.as_records(df), ["conv_id", "turn"])
    layouts = {"message", "value", "nested", "prompt", "instruction", "messages", "conversations"}
    assert {r.layout for r in turns.select("layout").distinct().collect()} == layouts
    got = {r.conv_id: chat.read_back(r.formatted) for r in chat.format_chats(turns).collect()}
    want = {}
    for conv_id, _, role, text in rows:
        want.setdefault(conv_id, []).append((role, text))
    assert got == want


def test_formatted_chats_are_read_back(spark):
    rows = [
        (1, 1, "assistant", "</s>[INST]\\"), (1, 0, "user", None), (1, 2, "assistant", "é😀"),
        (2, 0, None, ""), (2, 0, "user", "x"), (2, 0, "user", "x"), (None, 5, "user", "n"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.canonical_turns(chat.as_records(df), ["conv_id", "turn"])
    got = {r.conv_id: r for r in chat.format_chats(turns).collect()}
    assert chat.read_back(got[1].formatted) == [
        ("user", ""), ("assistant", "</s>[INST]\\"), ("assistant", "é😀"),
    ]
    masked = [got[1].formatted[m.start : m.end] for m in got[1].loss_mask]
    assert [chat.unescaped(m) for m in masked] == ["</s>[INST]\\", "é😀"]
    assert chat.read_back(got[2].formatted) == [("", ""), ("user", "x"), ("user", "x")]
    assert set(got) == {1, 2, None}
    assert chat.format_chats(turns.limit(0)).collect() == []


def test_keys_with_dots_and_brackets_are_no_layout(spark):
    records = [
        {"message.author.role": "user", "message.content.text": "hi"},
        {"messages[]": "secret"},
        {"": {"prompt": "a", "completion": "b"}},
        {"prompt": "a", "completion": "b", "x.id": "c"},
        {"prompt": "a", "completion": "b", "x\\did": "c"},
        {"message": {"author": {"role": "user"}, "content": {"text": "hi"}}},
    ]
    rows = [(i, 0, json.dumps(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, record string")
    got = chat.canonical_turns(df, ["conv_id", "turn"]).collect()
    unread = {r.conv_id: json.loads(r.unread) for r in got if r.unread is not None}
    assert unread == dict(enumerate(records[:5]))
    assert [(r.role, r.text) for r in got if r.conv_id == 5] == [("user", "hi")]
    assert len({frozenset(chat.paths_of(r)) for r in records}) == len(records)

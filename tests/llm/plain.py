"""Small documents with every odd case, and plain answers to compare with."""

import random
import re

from pyspark.sql import functions as F

#: Names that operators use for columns of their own.
CLASHING = (
    "seg", "ids", "row", "words", "node", "size", "key", "tokens", "budget", "x", "label",
    "score", "group", "n", "lo", "term", "pos", "range", "own", "id", "window", "component",
    "start", "end", "part", "epoch", "_text", "_record",
)
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_texts(seed=1, count=40):
    """Texts with copies, edits, shared passages, and hard cases."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "naïve", "漢字", "a,b", "X"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    texts = [None, "", " \t\n", "one", "one two", "ONE TWO", "\x00", "😀 é", "a" * 700]
    for _ in range(count):
        t = text(rng.randrange(1, 120))
        texts.append(t)
        if rng.random() < 0.4:
            texts.append(t)
        if rng.random() < 0.6:
            parts = t.split(" ")
            parts[rng.randrange(len(parts))] = rng.choice(words)
            texts.append(" ".join(parts))
        if rng.random() < 0.3:
            texts.append(text(5) + "\n" + t)
    texts.append(text(9000))
    return texts


def frame(spark, texts, extra=True):
    """Documents of the texts; with repeated rows, a null id and extra columns."""
    rows = [
        (i, t, ("en", "de", None)[i % 3], ("src0", "src7", "other", None)[i % 4], len(t or ""))
        for i, t in enumerate(texts)
    ]
    if extra:
        rows += [rows[-2], rows[3], (None, "w1 w2 w3 w4 w5 w6", None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        df = df.withColumns({c: F.lit(7) for c in CLASHING})
    return df


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def components(sets, percent):
    """Smallest id of each id's component."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    listed = sorted(sets)
    for a in listed:
        for b in listed:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def removed_bytes(texts, length):
    """Per text, whether each byte is in a string that starts twice."""
    counts = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            counts[t[p : p + length]] = counts.get(t[p : p + length], 0) + 1
    out = []
    for t in texts:
        covered = [False] * len(t)
        for p in range(len(t) - length + 1):
            if counts[t[p : p + length]] > 1:
                covered[p : p + length] = [True] * length
        out.append(covered)
    return out


def benchmark_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def contamination(texts, items, window):
    """Per text: words, hit words and item ids."""
    grams = {}
    for item, text in items:
        words = benchmark_words(text)
        if item is not None and words:
            for s in range(max(1, len(words) - window + 1)):
                grams.setdefault(tuple(words[s : s + window]), set()).add(str(item))
    out = []
    for text in texts:
        words, hit, found = benchmark_words(text), set(), set()
        for size in {len(g) for g in grams}:
            for s in range(len(words) - size + 1):
                items_ = grams.get(tuple(words[s : s + size]))
                if items_:
                    hit |= set(range(s, s + size))
                    found |= items_
        out.append((len(words), len(hit), sorted(found)))
    return out

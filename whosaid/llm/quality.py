"""Operator 7: a quality classifier by regularised quadratic discriminants."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType

#: What is measured of a text, in the order of the features.
FEATURES = (
    "log_bytes",
    "log_words",
    "log_word_bytes",
    "log_line_bytes",
    "upper_share",
    "digit_share",
    "stop_share",
    "comma_share",
    "symbol_share",
    "odd_ascii_share",
    "wide_share",
    "repeated_words",
    "repeated_lines",
    "short_words",
    "frequent_words",
    "longest_word",
)
#: The prediction's threshold, and the share of rows by remainder that are not
#: learned from.
THRESHOLD, FOLDS, HELD_OUT = 0.7, 4, 2

# Classes of bytes, by which features are counted.
_CLASS = np.zeros(256, np.uint8)
for _class, _bytes in enumerate(
    (
        b"abcdefghijklmnopqrstuvwxyz",
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b".!?",
        b",;:",
        b"\n\r",
        b" \t\x0b\x0c",
        b"'\"()-",
        bytes(range(128, 256)),
    ),
    start=1,
):
    _CLASS[list(_bytes)] = _class
N_CLASSES = 10


#: Words, lines and bytes of plain prose that each text is counted with, so that
#: shares of short texts say less; and such prose's shares.
PRIOR_WORDS, PRIOR_LINES, PRIOR_BYTES = 12, 3, 70
PRIOR = {"upper": 0.014, "stop": 0.015, "comma": 0.009, "short": 0.29, "repeated": 0.18,
         "frequent": 0.05, "word": 5.2, "line": 180.0}


def _share(count: float, size: float, prior_size: float, prior: float = 0.0) -> float:
    """A share with its low end spread out."""
    return float(np.sqrt((count + prior_size * prior) / (size + prior_size)))


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a whole text; an empty one has them too."""
    n = len(text)
    counts = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=N_CLASSES)
    other, _, upper, digit, stop, comma, _, _, mild, wide = counts.tolist()
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n_words, n_lines = len(words), len(lines)
    distinct = set(words)
    frequent = min(1, n_words)
    if len(distinct) < n_words:
        tally: dict[bytes, int] = {}
        for word in words:
            tally[word] = tally.get(word, 0) + 1
        frequent = max(tally.values())
    word_bytes = (sum(map(len, words)) + PRIOR_WORDS * PRIOR["word"]) / (n_words + PRIOR_WORDS)
    line_bytes = (n + PRIOR_LINES * PRIOR["line"]) / (n_lines + PRIOR_LINES)
    short = sum(len(w) <= 3 for w in words)
    return [
        float(np.log(n + PRIOR_BYTES)),
        float(np.log(n_words + PRIOR_WORDS)),
        float(np.log(word_bytes)),
        float(np.log(line_bytes)),
        _share(upper, n, PRIOR_BYTES, PRIOR["upper"]),
        _share(digit, n, PRIOR_BYTES),
        _share(stop, n, PRIOR_BYTES, PRIOR["stop"]),
        _share(comma, n, PRIOR_BYTES, PRIOR["comma"]),
        _share(other, n, PRIOR_BYTES),
        _share(mild, n, PRIOR_BYTES),
        _share(wide, n, PRIOR_BYTES),
        _share(n_words - len(distinct), n_words, PRIOR_WORDS, PRIOR["repeated"]),
        _share(n_lines - len(set(lines)), n_lines, PRIOR_LINES),
        _share(short, n_words, PRIOR_WORDS, PRIOR["short"]),
        _share(frequent, n_words, PRIOR_WORDS, PRIOR["frequent"]),
        float(np.log(max(map(len, words), default=0) + PRIOR["word"])),
    ]


def _measured(
    docs: DataFrame,
    keep: list[str],
    name: str,
    kind: DataType,
    value: Callable[[np.ndarray], pa.Array],
) -> DataFrame:
    """The columns ``keep`` and one made of each row's statistics."""
    given = docs.select(
        *keep, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_measured")
    )
    schema = given.drop("_measured").schema.add(name, kind)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column("_measured")]
            made = value(np.array(x).reshape(-1, len(FEATURES)))
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, made], [*keep, name])

    return given.mapInArrow(measure, schema)


@dataclass(frozen=True)
class Discriminant:
    """Two classes' log priors, means and inverse Cholesky factors of their
    covariances, and the logarithms of the factors' determinants."""

    priors: list[float]
    means: list[list[float]]
    inverses: list[list[list[float]]]
    log_dets: list[float]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Discriminant:
        return cls(**json.loads(text))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 of each row of statistics, from the
        difference of log densities."""

        def log_density(i: int) -> np.ndarray:
            z = (x - np.array(self.means[i])) @ np.array(self.inverses[i]).T
            return self.priors[i] - self.log_dets[i] - (z * z).sum(axis=1) / 2

        odds = np.clip(log_density(1) - log_density(0), -500, 500)
        return 1 / (1 + np.exp(-odds))


def fit(labelled: DataFrame, shrinkage: float = 0.01, pooled: float = 0.05) -> Discriminant:
    """The discriminant of rows (x, label), labels 0 and 1.

    Each class covariance is mixed with the pooled one by ``pooled``, then with
    its own diagonal by ``shrinkage``. Rows are summed where they are: the
    driver gets one row of sums and products per class. Without rows of both
    classes every score is the share of class 1, or one half.
    """
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    x = F.col("x")
    sums = (
        labelled.where("label in (0, 1)")
        .groupBy("label")
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(x[i]) for i in range(d)]).alias("s"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("p"),
        )
        .collect()
    )
    found = {row["label"]: row for row in sums}
    n = [found[c]["n"] if c in found else 0 for c in (0, 1)]
    if min(n) < 2:
        share = (n[1] + 1) / (sum(n) + 2)
        zeros, nothing = [[0.0] * d] * 2, [[[0.0] * d] * d] * 2
        return Discriminant([np.log(1 - share), np.log(share)], zeros, nothing, [0.0, 0.0])
    means, scatters = [], []
    for c in (0, 1):
        mean = np.array(found[c]["s"]) / n[c]
        products = np.zeros((d, d))
        for (i, j), p in zip(pairs, found[c]["p"]):
            products[i, j] = products[j, i] = p
        means.append(mean)
        scatters.append(products - n[c] * np.outer(mean, mean))
    common = (scatters[0] + scatters[1]) / (sum(n) - 2)
    inverses, log_dets = [], []
    for c in (0, 1):
        own = scatters[c] / (n[c] - 1)
        mixed = (1 - pooled) * own + pooled * common
        diagonal = np.diag(np.diag(mixed) + 1e-6)
        factor = np.linalg.cholesky((1 - shrinkage) * mixed + shrinkage * diagonal)
        inverses.append(np.linalg.inv(factor).tolist())
        log_dets.append(float(np.log(np.diag(factor)).sum()))
    return Discriminant(
        [float(np.log(n[c] / sum(n))) for c in (0, 1)],
        [m.tolist() for m in means],
        inverses,
        log_dets,
    )


def held_out(doc_id: Column) -> Column:
    """The rows whose labels are not learned from; a null id is not one."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def _listed(x: np.ndarray) -> pa.Array:
    return pa.array(x.tolist(), pa.list_(pa.float64()))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``x``, the statistics of each row's text.

    A null text counts as empty. Extra columns are left alone.
    """
    return _measured(docs, list(keep), "x", ArrayType(DoubleType()), _listed)


def train(statistics: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """A discriminant of the labelled rows (doc_id, x) that are not held out.

    All such rows count. Statistics meet their labels, so no text is moved. Rows
    without a label, and labels without a row, are not used; labels that repeat
    a doc_id with one value count once.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna().distinct()
    return fit(statistics.where(~held_out(F.col("doc_id"))).join(known, "doc_id"))


def scored(docs: DataFrame, model: Discriminant, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and each row's score, from its text alone.

    A null text counts as empty. Extra columns are left alone; only the text goes
    to Python.
    """

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        x = [statistics(t.as_py()) for t in texts]
        return pa.array(model.score(np.array(x).reshape(-1, len(FEATURES))), pa.float64())

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(*keep, score(text).alias("score"))


def scored_statistics(statistics: DataFrame, model: Discriminant) -> DataFrame:
    """Rows (doc_id, score) of rows (doc_id, x)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist()).reshape(-1, len(FEATURES))
            made = pa.array(model.score(x), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), made], ["doc_id", "score"]
            )

    rows = statistics.select(F.col("doc_id").cast("long").alias("doc_id"), "x")
    return rows.mapInArrow(score, "doc_id long, score double")

"""Operator 5: token counts of a unigram vocabulary by a Viterbi pass."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the tokenizer: the mark for a space, how far below the lowest
# score an unknown character is, and the piece types that texts match.
SPACE, UNKNOWN_PENALTY = "▁", 10.0
NORMAL_PIECE = 1
#: A score below this says only that a piece comes last.
LAST = -1e8

#: Characters that may stand alone, if the vocabulary allows it.
PUNCTUATION = ".,;:!?|\n"
#: A task forgets its words at this many.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores, and how the tokenizer treats a text before them."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool = True
    dummy_prefix: bool = True


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a model file, read on the driver.

    Its scores are taken as they are, as those of a unigram vocabulary; pieces
    marked to come last get one less than the lowest of the others, as such marks
    are beyond the tokenizer's own precision. Control, byte and unknown pieces
    match no text. Only models that leave the text as it
    is, but for marking its spaces, are read.
    """
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
        raise ValueError("the model changes texts before it matches pieces")
    scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL_PIECE}
    lowest = min(s for s in scores.values() if s > LAST) - 1
    return Vocabulary(
        tuple((p, max(s, lowest)) for p, s in scores.items()),
        model.trainer_spec.byte_fallback,
        rules.add_dummy_prefix,
    )


class Counter:
    """Counts the pieces of texts; an instance lives as long as a task."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary.pieces) - UNKNOWN_PENALTY
        # Neighbours that some piece has inside; between others each path has a cut.
        inside = {p[i : i + 2] for p, _ in vocabulary.pieces for i in range(len(p) - 1)}

        def apart(c: str) -> bool:
            return all(pair == c + c for pair in inside if c in pair)

        # Words are cut there where it takes only a look at one character: before
        # a run of spaces, and around punctuation that no piece has beside others.
        alone = "".join(c for c in PUNCTUATION if apart(c))
        if any(pair[1] == SPACE and pair[0] != SPACE for pair in inside):
            self.words = re.compile(r"(?s).+")
        else:
            others = "".join(map(re.escape, alone))
            runs = "".join(f"|{re.escape(c)}+" for c in alone)
            self.words = re.compile(f"{SPACE}*[^{SPACE}{others}]+|{SPACE}+{runs}")
        self.known: dict[str, tuple[int, float]] = {}

    def count(self, text: str) -> tuple[int, float]:
        """The number of pieces of the best path over a whole text, and its
        score."""
        if not text:
            return 0, 0.0
        marked = text.replace(" ", SPACE)
        if self.vocabulary.dummy_prefix:
            marked = SPACE + marked
        if not self.vocabulary.byte_fallback:
            return self.path(marked)  # runs of unknown characters cross cuts
        known = self.known
        pieces, score = 0, 0.0
        for word in self.words.findall(marked):
            found = known.get(word)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[word] = self.path(word)
            pieces += found[0]
            score += found[1]
        return pieces, score

    def path(self, text: str) -> tuple[int, float]:
        """The best path over a text.

        Of equal scores the piece that starts first wins, which is the longest;
        the automaton names those of an end in that order, and only a better
        score replaces one. A character that is no piece itself may be unknown:
        it is as many pieces as UTF-8 bytes, or, without bytes in the
        vocabulary, one with the unknown ones before it.
        """
        n = len(text)
        best, pieces, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        top, end, score, count, single = None, 1, 0.0, 0, False

        def close() -> None:
            """Settle an end whose pieces are all known."""
            if not single:
                start = end - 1
                fallback = best[start] + self.unknown
                if top is None or fallback > score:
                    best[end], unknown[end] = fallback, True
                    pieces[end] = pieces[start] + (
                        len(text[start].encode())
                        if self.vocabulary.byte_fallback
                        else not unknown[start]
                    )
                    return
            best[end], pieces[end] = score, count

        for last, (size, piece_score) in self.automaton.iter(text):
            while end <= last:
                close()
                top, single = None, False
                end += 1
            start = end - size
            candidate = best[start] + piece_score
            if top is None or candidate > score:
                top, score, count = start, candidate, pieces[start] + 1
            if size == 1:
                single = True
        while end <= n:
            close()
            top, single = None, False
            end += 1
        return pieces[n], best[n]


def token_counts(
    docs: DataFrame, vocabulary: Vocabulary, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep``, n_tokens and best_score for each row's whole text.

    A null or empty text has no tokens. Scores are added without rounding,
    whatever the length of the text. Repeated words are counted once per task as
    far as it remembers them: between two characters that no piece has next to
    each other, every path has a cut, so that the best path over a text is that
    over its parts.
    """
    given = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    schema = given.drop("_text").schema.add("n_tokens", "long").add("best_score", "double")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            counts = [counter.count(t) for t in batch.column("_text").to_pylist()]
            n, score = zip(*counts) if counts else ((), ())
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n, pa.int64()), pa.array(score, pa.float64())],
                [*keep, "n_tokens", "best_score"],
            )

    return given.mapInArrow(tally, schema)

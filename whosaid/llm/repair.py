"""Operator 11: the cheapest edits that give conversations their order of roles.

An edit is kept, given another role, deleted or inserted; what comes out must be
nothing, or turns of user and assistant behind at most one of the system. The
search goes row by row with a few states, each with its cheapest edits so far.
Those are paths of linked nodes that share what they have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from whosaid.llm.tables import stored
from whosaid.operators.skew import spread_join

#: What ASCII white space is, and what ends a sentence.
BLANKS = " \t\n\x0b\f\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5

#: States: nothing yet, behind the system's turn, a user's, an assistant's.
STATES = range(4)
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The role that a turn must have which is inserted or given another role.
_FREE = ("user", "user", "assistant", "user")
_ADJACENT = ("su", "ua", "au")
#: Rows whose paths are held at once.
PIECE = 2048

_BASE, _PRIME = 1_000_003, (1 << 61) - 1

COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")
PIECES = (
    "conv_id long, part long, number long, rows long, blank long, duplicate long, "
    "truncated long, illegal long, turns long, first string, last string, first_turn long, "
    "last_turn long, costs array<long>, audits array<string>"
)
REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string"
)
_KINDS = {
    "long": pa.int64(), "string": pa.string(),
    "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in ddl.split(", ")])


class Paths:
    """Sequences of edits as linked nodes: a node is its parent's edits and one more.

    A node knows its ancestors 1, 2, 4, ... edits before and a rolling hash of its
    edits, so that the first difference of two paths is found in logarithmic steps.
    Equal hashes are verified along the nodes; nodes that were found equal are
    remembered as one.
    """

    def __init__(self, prime: int = _PRIME) -> None:
        self.prime = prime
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]
        self.alias = [0]

    def add(self, parent: int, letter: str) -> int:
        node = len(self.letter)
        ancestors = [parent]
        for j in range(self.depth[parent].bit_length()):
            above = self.up[ancestors[j]]
            if j >= len(above):
                break
            ancestors.append(above[j])
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(letter)) % self.prime)
        self.up.append(ancestors)
        self.alias.append(node)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        steps = self.depth[node] - depth
        for j in range(steps.bit_length()):
            if steps >> j & 1:
                node = self.up[node][j]
        return node

    def edits(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _one(self, node: int) -> int:
        while self.alias[node] != node:
            self.alias[node] = self.alias[self.alias[node]]
            node = self.alias[node]
        return node

    def same(self, x: int, y: int) -> bool:
        """Are the edits of two nodes of one depth equal? Verified, not by hash."""
        passed = []
        while (a := self._one(x)) != (b := self._one(y)):
            if self.hash[x] != self.hash[y] or self.letter[x] != self.letter[y]:
                return False
            passed.append((a, b))
            x, y = self.up[x][0], self.up[y][0]
        for a, b in passed:
            self.alias[max(a, b)] = min(a, b)
        return True

    def less(self, x: int, x_letter: str, y: int, y_letter: str) -> bool:
        """Do the edits of x and one more come before those of y and one more?"""
        if x == y:
            return x_letter < y_letter
        common = min(self.depth[x], self.depth[y])
        a, b = self.ancestor(x, common), self.ancestor(y, common)
        if self.hash[a] == self.hash[b]:
            if not self.same(a, b):
                return self.edits(x) + x_letter < self.edits(y) + y_letter
            if self.depth[x] > common:
                x_letter = self.letter[self.ancestor(x, common + 1)]
            if self.depth[y] > common:
                y_letter = self.letter[self.ancestor(y, common + 1)]
            if x_letter == y_letter:
                return self.depth[x] < self.depth[y]
            return x_letter < y_letter
        # Up to the first nodes that differ.
        for j in reversed(range(len(self.up[a]))):
            if j < len(self.up[a]) and self.hash[self.up[a][j]] != self.hash[self.up[b][j]]:
                a, b = self.up[a][j], self.up[b][j]
        if not self.same(self.up[a][0], self.up[b][0]):
            return self.edits(x) + x_letter < self.edits(y) + y_letter
        return self.letter[a] < self.letter[b]


Best = list[tuple[int, int] | None]


def _offer(paths: Paths, best: list, state: int, cost: int, parent: int, letter: str) -> None:
    """Take a path to a state if it is cheaper, or as cheap and earlier in order."""
    old = best[state]
    if old is None or cost < old[0] or (cost == old[0] and paths.less(parent, letter, *old[1:])):
        best[state] = (cost, parent, letter)


def inserted(paths: Paths, best: Best) -> Best:
    """The states, after turns that are inserted here."""
    best = list(best)
    for state in (0, 1, 3, 2):
        if best[state] is None:
            continue
        cost, node = best[state]
        target = _NEXT[state, _FREE[state][0]]
        old = best[target] and (best[target][0], *_last(paths, best[target][1]))
        offered = [None] * 4
        offered[target] = old
        _offer(paths, offered, target, cost + COSTS[INSERT], node, INSERT)
        if offered[target] is not old:
            made = offered[target]
            best[target] = (made[0], paths.add(*made[1:]))
    return best


def _last(paths: Paths, node: int) -> tuple[int, str]:
    return (paths.up[node][0], paths.letter[node]) if node else (0, "")


def edited(paths: Paths, best: Best, initial: str, fault: str) -> Best:
    """The states behind one row."""
    found: list = [None] * 4
    extra = TRUNCATED if fault == "truncated" else 0
    for state in STATES:
        if best[state] is None:
            continue
        cost, node = best[state]
        _offer(paths, found, state, cost + COSTS[DELETE], node, DELETE)
        if fault in ("blank", "duplicate"):
            continue
        kept = _NEXT.get((state, initial))
        if kept is not None:
            _offer(paths, found, kept, cost + extra, node, KEEP)
        given = _NEXT[state, _FREE[state][0]]
        _offer(paths, found, given, cost + extra + COSTS[REROLE], node, REROLE)
    return [f and (f[0], paths.add(*f[1:])) for f in found]


def transitions(rows: Iterable[tuple[str, str]], starts: Iterable[int]) -> tuple[list, list]:
    """Costs and edits from each start (rows of 4) to each state, for some rows."""
    rows = list(rows)
    costs, audits = [None] * 16, [None] * 16
    for start in starts:
        paths = Paths()
        best: Best = [None] * 4
        best[start] = (0, 0)
        for initial, fault in rows:
            best = edited(paths, inserted(paths, best), initial, fault)
        for state in STATES:
            if best[state] is not None:
                costs[start * 4 + state] = best[state][0]
                audits[start * 4 + state] = paths.edits(best[state][1])
    return costs, audits


def chained(pieces: Iterable[tuple[list, list]]) -> tuple[int, str]:
    """The cheapest edits of a whole conversation, from those of its pieces."""
    best: list = [(0, ""), None, None, None]
    for costs, audits in pieces:
        after: list = [None] * 4
        for start, old in enumerate(best):
            for state in STATES:
                cost = costs[start * 4 + state]
                if old is None or cost is None:
                    continue
                made = (old[0] + cost, old[1] + audits[start * 4 + state])
                if after[state] is None or made < after[state]:
                    after[state] = made
        best = after
    for state in (0, 1, 2):
        if best[state] is not None:
            target = _NEXT[state, _FREE[state][0]]
            made = (best[state][0] + COSTS[INSERT], best[state][1] + INSERT)
            if best[target] is None or made < best[target]:
                best[target] = made
    return min(b for b in (best[0], best[3]) if b is not None)


def _events(row: dict) -> Iterator[tuple[str, str]]:
    """(initial, fault) of a row and of its copies."""
    fault = (
        "blank" if row["blank"]
        else "duplicate" if row["duplicate"]
        else "truncated" if row["truncated"] else ""
    )
    yield row["initial"], fault
    for _ in range(row["copies"] - 1):
        yield row["initial"], fault if fault == "blank" else "duplicate"


class _Piece:
    """Some rows of a conversation, in order, and what is counted of them."""

    def __init__(self, starts: Iterable[int]) -> None:
        self.starts = starts
        self.events: list[tuple[str, str]] = []
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, event: tuple[str, str]) -> None:
        if self.events and self.events[-1][0] + event[0] not in _ADJACENT:
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.events.append(event)

    def row(self, conv_id: int, part: int, number: int) -> dict:
        costs, audits = transitions(self.events, self.starts)
        faults = [fault for _, fault in self.events]
        return {
            "conv_id": conv_id,
            "part": part,
            "number": number,
            "rows": len(faults),
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": self.illegal,
            "turns": self.turns,
            "first": self.events[0][0] if faults else None,
            "last": self.events[-1][0] if faults else None,
            "first_turn": self.first_turn,
            "last_turn": self.last_turn,
            "costs": costs,
            "audits": audits,
        }


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to pieces; a conversation may go on from the part before."""
    part = TaskContext.get().partitionId()
    number, piece, conv_id = 0, None, None
    out: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if piece is None or row["conv_id"] != conv_id:
                if piece is not None:
                    out.append(piece.row(conv_id, part, number))
                    number += 1
                # Only the first of a part may stand behind other rows.
                piece = _Piece([0] if number else STATES)
                conv_id = row["conv_id"]
            if row["kind"] == 0:
                continue
            for event in _events(row):
                if len(piece.events) == PIECE:
                    out.append(piece.row(conv_id, part, number))
                    number += 1
                    piece = _Piece(STATES)
                piece.add(row["turn"], event)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_schema(PIECES))
            out = []
    if piece is not None:
        yield pa.RecordBatch.from_pylist(
            [piece.row(conv_id, part, number)], schema=_schema(PIECES)
        )


def _report(pieces: pa.Table) -> pa.Table:
    """One conversation's counts and edits."""
    rows = sorted(pieces.to_pylist(), key=lambda r: (r["part"], r["number"]))
    cost, audit = chained((r["costs"], r["audits"]) for r in rows)
    full = [r for r in rows if r["rows"]]
    known = [r for r in full if r["turns"]]
    illegal = sum(r["illegal"] for r in full)
    illegal += sum(a["last"] + b["first"] not in _ADJACENT for a, b in zip(full, full[1:]))
    turns = sum(r["turns"] for r in known)
    turns -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(known, known[1:]))
    reach = known[-1]["last_turn"] - known[0]["first_turn"] + 1 if known else 0
    out = {
        "conv_id": rows[0]["conv_id"],
        "gaps": reach - turns,
        **{c: sum(r[c] for r in full) for c in ("blank", "duplicate", "truncated")},
        "illegal": illegal,
        "cost": cost,
        "audit": audit,
    }
    return pa.Table.from_pylist([out], schema=_schema(REPORT))


ORDER = ("turn", "role", "text_key")


def _ordered(prefix: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in (*prefix, *ORDER)]


def listed(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Stored rows, each different one once with its copies, and one row (kind 0)
    per conversation; ``same`` stands for a conversation's role and text."""
    given = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.lit(1).alias("kind"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    heads = (rows if ids is None else ids).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.lit("").alias("text"),
    )
    once = (
        given.union(heads)
        .groupBy("conv_id", "kind", "turn", "role", "text")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    text_key = F.unhex(F.sha2("text", 256))
    identity = F.struct("conv_id", "kind", "role", F.hex(text_key).alias("text"))
    return stored(
        once.withColumn("text_key", text_key).withColumn(
            "same", F.unhex(F.sha2(F.to_json(identity), 256))
        )
    )


def audits(rows: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Rows (REPORT) for listed rows.

    Texts do not move: their faults and digests do. Rows are ordered by ranges, so
    that a long conversation is many tasks' work; each piece gives the cheapest
    edits from each state to each, and a conversation's pieces are chained.
    """
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    marked = rows.select(
        "conv_id", "kind", "turn", "role", "text_key", "copies", "same",
        F.substring("role", 1, 1).alias("initial"),
        (F.rtrim("text", F.lit(BLANKS)) == "").alias("blank"),
        (~F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1)).isin(*ENDS)).alias("truncated"),
        place.alias("place"),
    )
    first = marked.groupBy(F.col("same").alias("first_same")).agg(F.min("place").alias("first"))
    known = spread_join(first, marked, "first_same", "same", hot_rows)
    narrow = known.select(
        "conv_id", "kind", *ORDER, "copies", "initial", "blank", "truncated",
        (F.col("place") > F.col("first")).alias("duplicate"),
    )
    order = _ordered(["conv_id", "kind"])
    pieces = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    return (
        pieces.mapInArrow(_pieces, PIECES)
        .groupBy("conv_id")
        .applyInArrow(lambda some: _report(some), REPORT)
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """Each conversation's report, with the turns that its edits give from the rows
    behind it, which must be read to their end."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    stream = rows()
    waiting: list[dict] = [r for r in [next(stream, None)] if r]

    def turns(audit: str) -> Iterator[tuple[str, str]]:
        state, at = 0, 0

        def given() -> str:
            return _FREE[state]

        def moved(role: str) -> int:
            return _NEXT[state, role[0]]

        def inserts() -> Iterator[tuple[str, str]]:
            nonlocal state, at
            while at < len(audit) and audit[at] == INSERT:
                role = given()
                state, at = moved(role), at + 1
                yield role, ""

        for row in stream:
            if row["kind"] == 0:
                waiting.append(row)
                break
            for _ in range(row["copies"]):
                yield from inserts()
                edit = audit[at]
                at += 1
                if edit != DELETE:
                    role = row["role"] if edit == KEEP else given()
                    state = moved(role)
                    yield role, row["text"]
        yield from inserts()

    while waiting:
        report = waiting.pop()
        yield report, turns(report["audit"])


def _with_reports(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report and then its rows, in order. A conversation is one
    task's, which reads its rows one after the other and keeps none."""
    texts = rows.where("kind = 1").select("conv_id", "kind", *ORDER, "text", "copies")
    heads = reports.withColumn("kind", F.lit(0))
    both = heads.unionByName(texts, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*_ordered(["conv_id", "kind"]))


def repaired_turns(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text), the repaired turns from 0 on, of listed rows."""
    ddl = "conv_id long, turn long, role string, text string"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for report, turns in _walk(batches):
            for number, (role, text) in enumerate(turns):
                out.append({"conv_id": report["conv_id"], "turn": number, "role": role, "text": text})
                if len(out) == PIECE:
                    yield pa.RecordBatch.from_pylist(out, schema=_schema(ddl))
                    out = []
        yield pa.RecordBatch.from_pylist(out, schema=_schema(ddl))

    return _with_reports(rows, reports).mapInArrow(write, ddl)


def repair_digests(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports, each with the SHA-256 of the repaired "role:text" lines."""
    ddl = f"{REPORT}, repaired_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for report, turns in _walk(batches):
            made, between = hashlib.sha256(), b""
            for role, text in turns:
                made.update(between + role.encode() + b":")
                made.update(text.encode())
                between = b"\n"
            row = {c.split()[0]: report[c.split()[0]] for c in REPORT.split(", ")}
            out.append(row | {"repaired_sha256": made.hexdigest()})
            if len(out) == PIECE:
                yield pa.RecordBatch.from_pylist(out, schema=_schema(ddl))
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=_schema(ddl))

    return _with_reports(rows, reports).mapInArrow(digest, ddl)


def repair_conversations(
    rows: DataFrame, ids: DataFrame | None = None, hot_rows: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Reports and repaired turns of conversations with rows (conv_id, turn, role, text).

    Reports have a row per conv_id of ``ids``, or of the rows: gaps in the turns'
    numbers, rows by their first fault (blank, duplicate of an earlier role and text,
    truncated before the end of its last sentence), adjacent roles out of order, and
    the cheapest edits (K, R, D, I) with their cost; of equally cheap ones the first
    in ASCII order. Roles count by their first letter. A blank or duplicate row must
    be deleted; a truncated one that stays costs more. Inserted turns have no text.

    Rows go by turn, null first; those of one turn by role and then by the digest of
    their text. A null role is none, a null text empty; a null conv_id is a
    conversation of its own. Rows that repeat are duplicates and held as a count.
    A conversation without rows has zeros and no edits. An empty table gives no rows.
    """
    kept = listed(rows, ids)
    reports = stored(audits(kept, hot_rows))
    return reports, repaired_turns(kept, reports)


def repair_report(
    rows: DataFrame, ids: DataFrame | None = None, hot_rows: int | None = None
) -> DataFrame:
    """The reports of ``repair_conversations`` with digests of the repaired turns."""
    kept = listed(rows, ids)
    return repair_digests(kept, stored(audits(kept, hot_rows)))

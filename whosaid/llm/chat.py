"""Operator 8: chat formatting by schema fingerprints."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What marks a turn, and control strings of other templates,
# which are escaped inside texts like the marks.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = (
    TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
)
#: The escape character: it is doubled, and it splits control strings.
ESCAPE = "\\"
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_FORMATTED = re.compile(
    f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL
)

#: Other names of the canonical roles.
ROLES = {
    "human": "user",
    "prompter": "user",
    "gpt": "assistant",
    "bot": "assistant",
    "model": "assistant",
}


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns.

    ``fields`` lists (path, role): each present text is a turn of that role.
    ``turns`` is the path of a list whose items have a ``role`` path and a
    ``text`` path; an empty path is the record itself. Paths are keys joined by
    dots.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    turns: str | None = None
    role: str = ""
    text: str = ""


#: How a key writes the characters that mean something in a path.
_IN_KEY = str.maketrans({"\\": "\\\\", ".": "\\d", "[": "\\o", "]": "\\c", "\n": "\\n"})


def _step(key: str) -> str:
    """A key as a step of a path; no two keys have one."""
    return key.translate(_IN_KEY) or "\\e"


def paths_of(value: object, prefix: str = "") -> set[str]:
    """The field paths of a JSON value; all items of a list share one path.

    Keys with dots or brackets are no nested fields or lists, see ``_step``.
    """
    if isinstance(value, dict):
        out = set()
        for key, item in value.items():
            out |= paths_of(item, f"{prefix}.{_step(key)}" if prefix else _step(key))
        return out
    if isinstance(value, list):
        out = {f"{prefix}[]"}
        for item in value:
            if isinstance(item, (dict, list)):
                out |= paths_of(item, f"{prefix}[]")
        return out
    return {prefix}


def schema_fingerprint(paths: set[str]) -> str:
    """A digest of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def layout(mapping: Mapping, *path_sets: Sequence[str]) -> dict[str, Mapping]:
    return {schema_fingerprint(set(paths)): mapping for paths in path_sets}


def _list_paths(name: str, *keys: str) -> tuple[str, ...]:
    return (f"{name}[]", *(f"{name}[].{k}" for k in keys))


#: The known layouts by the fingerprint of their paths.
LAYOUTS: dict[str, Mapping] = {
    **layout(
        Mapping("prompt", (("system", "system"), ("prompt", "user"), ("completion", "assistant"))),
        ("prompt", "completion"),
        ("system", "prompt", "completion"),
    ),
    **layout(
        Mapping("question", (("question", "user"), ("answer", "assistant"))),
        ("question", "answer"),
    ),
    **layout(
        Mapping(
            "instruction",
            (("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
        ),
        ("instruction", "output"),
        ("instruction", "input", "output"),
        ("system", "instruction", "output"),
        ("system", "instruction", "input", "output"),
    ),
    **layout(
        Mapping("messages", turns="messages", role="role", text="content"),
        _list_paths("messages", "role", "content"),
        ("messages[]",),
    ),
    **layout(
        Mapping("conversations", turns="conversations", role="from", text="value"),
        _list_paths("conversations", "from", "value"),
        ("conversations[]",),
    ),
    **layout(Mapping("message", turns="", role="role", text="content"), ("role", "content")),
    **layout(Mapping("value", turns="", role="from", text="value"), ("from", "value")),
    **layout(
        Mapping("nested", turns="", role="message.author.role", text="message.content.text"),
        ("message.author.role", "message.content.text"),
    ),
}


#: Keys that say something about a record or a turn and are no text of it. Their
#: paths, and those below them, do not count for a layout.
OPTIONAL = frozenset(
    "id uuid conversation_id message_id parent_id index source dataset origin url license lang "
    "language weight score rating timestamp created_at date metadata meta tags category".split()
)


def _counted(paths: set[str]) -> set[str]:
    """The paths without those of optional keys."""
    return {
        p for p in paths if not any(k.removesuffix("[]") in OPTIONAL for k in p.split("."))
    }


def _at(value: object, path: str) -> object:
    for key in path.split("."):
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _spelled(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def turns_of(record: object, mapping: Mapping) -> Iterator[tuple[str, str]]:
    """The canonical (role, text) turns of a record; an item of a list that is
    no record is refused."""
    for path, role in mapping.fields:
        text = _at(record, path)
        if text is not None:
            yield role, _spelled(text)
    if mapping.turns is not None:
        items = _at(record, mapping.turns) if mapping.turns else [record]
        for item in items or []:
            if not isinstance(item, dict):
                raise ValueError("a turn is no record")
            role = _spelled(_at(item, mapping.role))
            yield ROLES.get(role, role), _spelled(_at(item, mapping.text))


def canonical_turns(
    records: DataFrame,
    keep: Sequence[str],
    record: str = "record",
    layouts: dict[str, Mapping] | None = None,
) -> DataFrame:
    """The columns ``keep`` and (layout, part, role, text, unread): a row per turn
    of each JSON record, numbered by ``part`` within the record.

    A record's layout is looked up by the fingerprint of its nested field paths,
    and if that is unknown, of those without the paths of optional keys. A record
    that is null, no JSON or of no known layout has one row with null role and
    text, the fingerprint as its layout (null without any), and the whole record
    in ``unread`` (empty for a null), so that nothing is lost; ``unread`` is null
    in other rows. A known record without turns has no rows. A null text is empty
    text.
    """
    known = dict(LAYOUTS if layouts is None else layouts)
    given = records.select(*keep, F.col(record).alias("_record"))
    schema = given.drop("_record").schema
    for field in ("layout", "part", "role", "text", "unread"):
        schema = schema.add(field, "integer" if field == "part" else "string")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[frozenset, str] = {}
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column("_record").to_pylist()):
                try:
                    value = json.loads(text) if text is not None else None
                except ValueError:
                    value = None
                if value is None:
                    rows.append((i, None, 0, None, None, text or ""))
                    continue
                paths = frozenset(paths_of(value))
                if paths not in seen:
                    seen[paths] = schema_fingerprint(set(paths))
                mapping = known.get(seen[paths])
                if mapping is None:
                    mapping = known.get(schema_fingerprint(_counted(set(paths))))
                try:
                    turns = None if mapping is None else list(turns_of(value, mapping))
                except ValueError:
                    turns = None
                if turns is None:
                    rows.append((i, seen[paths], 0, None, None, text))
                    continue
                rows += [(i, mapping.name, n, r, t, None) for n, (r, t) in enumerate(turns)]
            at, *values = zip(*rows) if rows else ([], [], [], [], [], [])
            kept = batch.select(list(keep)).take(pa.array(at, pa.int64()))
            types = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *(pa.array(v, t) for v, t in zip(values, types))],
                [*keep, "layout", "part", "role", "text", "unread"],
            )

    return given.mapInArrow(convert, schema)


def escaped(text: str) -> str:
    """The text without control strings: each is split after its first
    character, and the escape character is doubled."""
    doubled = text.replace(ESCAPE, ESCAPE * 2)
    return _CONTROL.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], doubled)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text starts and ends there."""
    head = TURN + escaped(role) + TEXT
    body = escaped(text)
    return head + body + END, len(head), len(head) + len(body)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescaped(r), unescaped(t)) for r, t in _FORMATTED.findall(formatted)]


FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("formatted", pa.string()),
        ("loss_mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


def format_chats(turns: DataFrame, learned: Sequence[str] = ("assistant",)) -> DataFrame:
    """Rows (conv_id, formatted, loss_mask), one per conversation of the rows
    (conv_id, turn, part, role, text), and ``unread`` if there is such a column.

    A row with a record that was not read fails the job: an empty turn would
    stand for its texts. Take such rows apart by ``unread is not null`` first.

    Turns are in the order of (turn, part), then role and text. The mask's spans
    are the code points of the formatted text that hold texts of the ``learned``
    roles, without marks. Null roles and texts are empty; rows of a null
    conv_id are one conversation. Rows are sorted by Spark and read one at a
    time; a conversation is as large as its text, and no more than one is held.
    """
    text = F.coalesce("text", F.lit(""))
    if "unread" in turns.columns:
        said = F.concat(
            F.lit("a record of no known layout in conversation "),
            F.coalesce(F.col("conv_id").cast("string"), F.lit("null")),
            F.lit(": "),
            F.substring("unread", 1, 200),
        )
        text = F.when(F.col("unread").isNull(), text).otherwise(F.raise_error(said))
    ordered = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            "part",
            F.coalesce("role", F.lit("")).alias("role"),
            text.alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "part", "role", "text")
        .select("conv_id", "role", "text")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in FORMATTED.names}
        size = 0
        for conv_id, turns_ in groupby(rows(batches), key=lambda r: r[0]):
            parts, mask, length = [], [], 0
            for _, role, text in turns_:
                part, start, end = formatted_turn(role, text)
                if role in learned:
                    mask.append({"start": length + start, "end": length + end})
                parts.append(part)
                length += len(part)
            out["conv_id"].append(conv_id)
            out["formatted"].append("".join(parts))
            out["loss_mask"].append(mask)
            size += length
            if size > 4_000_000:
                yield pa.RecordBatch.from_pydict(out, schema=FORMATTED)
                out, size = {c: [] for c in FORMATTED.names}, 0
        yield pa.RecordBatch.from_pydict(out, schema=FORMATTED)

    return ordered.mapInArrow(
        write,
        "conv_id long, formatted string, loss_mask array<struct<start:long,end:long>>",
    )


def digests(chats: DataFrame) -> DataFrame:
    """What is read back from formatted conversations: (conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = read_back(text)
                loss = "".join(unescaped(text[m["start"] : m["end"]]) for m in row["loss_mask"])
                out.append(
                    {
                        "conv_id": row["conv_id"],
                        "n_turns": len(turns),
                        "turns_sha256": digest("".join(f"{r}\n{t}\n" for r, t in turns)),
                        "loss_chars": len(loss),
                        "loss_sha256": digest(loss),
                        "formatted_chars": len(text),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return chats.mapInArrow(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )


#: Turns of a conversation that are written as one record at most.
TOGETHER = 64


def as_records(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, record): turns by row as JSON in several layouts, by
    conversation, as they come from different sources.

    Half of the conversations are records of one turn each, in three layouts. The
    others are one record: a prompt or an instruction where the roles fit, else a
    list of messages or of conversations. Those of more than ``TOGETHER`` turns
    or without an id are records of single turns.
    """
    turns = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    kind: Column = F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(6))
    whole = (
        turns.where(kind >= 3)
        .groupBy(F.col("conv_id").alias("whole"))
        .agg(F.count("*").alias("n"))
        .where(F.col("whole").isNotNull() & (F.col("n") <= TOGETHER))
    )
    turns = turns.join(whole, F.col("conv_id") == F.col("whole"), "left")

    plain = F.to_json(F.struct("role", F.col("text").alias("content")))
    shared = F.to_json(F.struct(F.col("role").alias("from"), F.col("text").alias("value")))
    nested = F.to_json(
        F.struct(
            F.struct(F.struct("role").alias("author"), F.struct("text").alias("content")).alias(
                "message"
            )
        )
    )
    single = F.when(kind % 3 == 0, plain).when(kind % 3 == 1, shared).otherwise(nested)
    ones = turns.where("whole is null").select("conv_id", "turn", single.alias("record"))

    def text(n: int) -> Column:
        return F.get("t", F.lit(n))["text"]

    def fields(*names: str) -> Column:
        return F.to_json(F.struct(*(text(n).alias(name) for n, name in enumerate(names))))

    def items(role: str, content: str) -> Column:
        return F.transform(
            "t", lambda x: F.struct(x["role"].alias(role), x["text"].alias(content))
        )

    roles = F.array_join(F.transform("t", lambda x: x["role"]), ",")
    asked = (
        F.when(roles == "user,assistant", fields("prompt", "completion"))
        .when(roles == "system,user,assistant", fields("system", "prompt", "completion"))
    )
    told = (
        F.when(roles == "user,assistant", fields("instruction", "output"))
        .when(roles == "user,user,assistant", fields("instruction", "input", "output"))
        .when(roles == "system,user,assistant", fields("system", "instruction", "output"))
        .when(
            roles == "system,user,user,assistant", fields("system", "instruction", "input", "output")
        )
    )
    messages = F.to_json(F.struct(items("role", "content").alias("messages")))
    conversations = F.to_json(F.struct(items("from", "value").alias("conversations")))
    record = (
        F.when(kind == 3, F.coalesce(asked, messages))
        .when(kind == 4, F.coalesce(told, conversations))
        .otherwise(messages)
    )
    together = (
        turns.where("whole is not null")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
        .select("conv_id", F.get("t", F.lit(0))["turn"].alias("turn"), record.alias("record"))
    )
    return ones.union(together)

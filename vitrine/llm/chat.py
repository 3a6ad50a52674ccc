"""Chat formatting: layouts picked by schema fingerprints, canonical turns, a reversible template.

Training records come in many layouts: a prompt and a response, an instruction with an input and an
output, a list of messages under several names, or one row per turn.  The sorted paths of a record's
nested fields are hashed, and the hash selects a declarative mapping that says where the turns are.  A
mapping names the paths that it needs; a record may have more, ids and sources for instance, and of
several mappings that fit the one with the most paths counts.  What a fingerprint selects is worked out
once.  A record whose fields fit no mapping is kept apart, never guessed at.

The template writes each turn as ``<|turn|>role``, a line break, the text and ``<|end|>`` with a line break.  Control
strings of this and other templates inside a role or text are broken by an escape after their first
character, so a text never ends its turn, and reading back gives exactly what was written.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import slices

TURN, END = "<|turn|>", "<|end|>\n"
ESCAPE = "␛"
# Strings that templates in use treat as control.
CONTROLS = (
    "<|turn|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>",
)
_BREAK = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ").", re.S)
_READ = re.compile(ESCAPE + "(.)", re.S)
_TEXT_OF = {"=": ESCAPE, "-": "", "n": "\n"}


@dataclass(frozen=True)
class Layout:
    """Where a record holds its turns.

    ``paths`` are the nested field paths that it needs.  ``fixed`` gives (role, path) turns in order,
    and ``listed`` a list with the paths of role and text inside its items; ``renamed`` says that
    roles have the names of ``ROLES``."""

    name: str
    paths: tuple[str, ...]
    fixed: tuple[tuple[str, str], ...] = ()
    listed: tuple[str, str, str] | None = None
    renamed: bool = False


LAYOUTS = (
    Layout("turn rows", ("role", "text"), listed=("", "role", "text")),
    Layout("prompt and response", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Layout("prompt and completion", ("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Layout("question and answer", ("question", "answer"), (("user", "question"), ("assistant", "answer"))),
    Layout("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Layout(
        "instruction with input", ("instruction", "input", "output"),
        (("user", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Layout(
        "system, prompt and response", ("system", "prompt", "response"),
        (("system", "system"), ("user", "prompt"), ("assistant", "response")),
    ),
    Layout("messages", ("messages[].role", "messages[].content"), listed=("messages", "role", "content")),
    Layout("conversation", ("conversations[].from", "conversations[].value"), listed=("conversations", "from", "value"),
           renamed=True),
    Layout("dialogue", ("turns[].role", "turns[].text"), listed=("turns", "role", "text")),
)
# Names that other layouts give to the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}


def fingerprint(paths) -> int:
    """Hash of a set of field paths, whatever their order."""
    return xxhash.xxh64_intdigest("\n".join(sorted(set(paths))).encode("utf-8", "surrogatepass"))


#: Layouts by the fingerprint of a record's paths: at first of those they need, then of all that came.
BY_FINGERPRINT: dict[int, Layout | None] = {fingerprint(layout.paths): layout for layout in LAYOUTS}
#: Fingerprints that a worker remembers; beyond them layouts are worked out anew.
REMEMBERED = 10_000


def layout_of(paths: Iterable[str]) -> Layout | None:
    """The layout that needs the most of a record's paths; of those that tie, the first."""
    held = set(paths)
    mark = fingerprint(held)
    if mark in BY_FINGERPRINT:
        return BY_FINGERPRINT[mark]

    def fits(layout: Layout) -> bool:
        empty = layout.listed is not None and f"{layout.listed[0]}[]" in held
        return empty or held.issuperset(layout.paths)

    found = max((x for x in LAYOUTS if fits(x)), key=lambda x: len(x.paths), default=None)
    if len(BY_FINGERPRINT) < REMEMBERED:
        BY_FINGERPRINT[mark] = found
    return found


def record_paths(value: Any, prefix: str = "") -> Iterator[str]:
    """Paths of the leaves of a parsed record; items of a list share one path."""
    if isinstance(value, dict):
        for key, inner in value.items():
            yield from record_paths(inner, f"{prefix}.{key}" if prefix else key)
    elif isinstance(value, list):
        if not value:
            yield f"{prefix}[]"
        for inner in value:
            yield from record_paths(inner, f"{prefix}[]")
    else:
        yield prefix


def type_paths(kind: T.DataType, prefix: str = "") -> Iterator[str]:
    """The same paths of a Spark type."""
    if isinstance(kind, T.StructType):
        for field in kind:
            yield from type_paths(field.dataType, f"{prefix}.{field.name}" if prefix else field.name)
    elif isinstance(kind, T.ArrayType):
        yield from type_paths(kind.elementType, f"{prefix}[]")
    else:
        yield prefix


def record_turns(record: dict, layout: Layout) -> list[tuple[str, str]]:
    """Canonical (role, text) turns; null and missing texts are empty, an empty optional input goes."""
    if layout.listed:
        field, role, text = layout.listed
        items = record.get(field) if field else [record]
        pairs = [(str(i.get(role) or ""), i.get(text)) for i in items or [] if isinstance(i, dict)]
        names = ROLES if layout.renamed else {}
        return [(names.get(r.lower(), r), "" if t is None else str(t)) for r, t in pairs]
    turns = []
    for role, path in layout.fixed:
        text = record.get(path)
        if path == "input" and not text:
            continue
        turns.append((role, "" if text is None else str(text)))
    return turns


def canonical_turns(df: DataFrame, id_col: str, record_col: str) -> DataFrame:
    """``(id_col, layout, turn, role, text)`` of JSON records in any of the layouts.

    A record that is null, no JSON object or of fields that fit no layout gives one row with null
    layout, turn, role and text, and one of no turns a row with its layout, so nothing is lost unseen.
    Null and missing texts are empty; a record of any length is read whole; records that repeat and
    ids that are null stay as they are; an empty table gives no rows; other columns are ignored."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, record_col):
            rows, names, numbers, roles, texts = [], [], [], [], []
            for row, raw in enumerate(batch.column(1).to_pylist()):
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                layout = layout_of(record_paths(record)) if isinstance(record, dict) else None
                turns = layout and record_turns(record, layout) or [(None, None)]
                for number, (role, text) in enumerate(turns):
                    rows.append(row)
                    names.append(layout.name if layout else None)
                    numbers.append(None if role is None else number)
                    roles.append(role)
                    texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()),
                    pa.array(numbers, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string()),
                ],
                names=[id_col, "layout", "turn", "role", "text"],
            )

    schema = f"`{id_col}` {kind}, layout string, turn bigint, role string, text string"
    return df.select(id_col, record_col).mapInArrow(run, schema)


def turn_rows(df: DataFrame, id_col: str, turn_col: str, record: str = "record") -> DataFrame:
    """``(id_col, turn_col, role, text)`` of a table with one row per turn, whose other fields, as a
    struct column ``record``, must have the fingerprint of a layout with one turn a row."""
    layout = layout_of(type_paths(df.schema[record].dataType))
    if layout is None or not layout.listed or layout.listed[0]:
        raise ValueError("the record's fields are not those of a layout with one turn a row")
    _, role, text = layout.listed
    return df.select(
        id_col,
        turn_col,
        F.coalesce(F.col(f"{record}.{role}").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"{record}.{text}").cast("string"), F.lit("")).alias("text"),
    )


def escaped(text: str, line: bool = False) -> str:
    """``text`` without control strings, reversibly; with ``line`` also without line breaks."""
    text = text.replace(ESCAPE, ESCAPE + "=")
    text = _BREAK.sub(lambda m: m.group() + ESCAPE + "-", text)
    return text.replace("\n", ESCAPE + "n") if line else text


def unescaped(text: str) -> str:
    return _READ.sub(lambda m: _TEXT_OF[m.group(1)], text)


def format_turn(role: str, text: str) -> str:
    return f"{TURN}{escaped(role, True)}\n{escaped(text)}{END}"


def read_turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin, end) of each turn; begin and end bound its escaped text, the loss span of
    an assistant turn, in characters of ``formatted``."""
    turns, place = [], 0
    while place < len(formatted):
        if not formatted.startswith(TURN, place):
            raise ValueError(f"no turn begins at character {place}")
        line = formatted.index("\n", place)
        end = formatted.index(END, line + 1)
        turns.append(
            (unescaped(formatted[place + len(TURN) : line]), unescaped(formatted[line + 1 : end]), line + 1, end)
        )
        place = end + len(END)
    return turns


def formatted(turns: DataFrame, id_col: str, turn_col: str) -> DataFrame:
    """``(id_col, turn_col, piece, loss)``: the formatted text of each turn and whether it is under
    the loss mask, in order inside each partition; a conversation is its pieces, joined.

    Conversations are dealt by id and sorted by turn (ties by role, then text), never gathered, so
    one of any length needs no more memory than a batch of turns.  Null ids form one conversation,
    null turns come first."""
    whole = turns.select(id_col, turn_col, "role", "text").repartition(id_col)
    ordered = whole.sortWithinPartitions(id_col, turn_col, "role", "text")
    kinds = [turns.schema[c].dataType.simpleString() for c in (id_col, turn_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            pieces = [format_turn(r or "", t or "") for r, t in zip(roles, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pieces, pa.string()), pa.array([r == "assistant" for r in roles])],
                names=[id_col, turn_col, "piece", "loss"],
            )

    return ordered.mapInArrow(run, f"`{id_col}` {kinds[0]}, `{turn_col}` {kinds[1]}, piece string, loss boolean")


def digests(pieces: DataFrame, id_col: str) -> DataFrame:
    """What reading the formatted pieces gives: per conversation the number of turns, hashes of all
    turns and of the text under the loss mask, and sizes.  Takes the order of ``formatted`` and
    holds one hash state, whatever the length of a conversation."""
    kind = pieces.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def flush(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in range(7)]
            kinds = [id_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def close(s) -> tuple:
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field(0).type
            done = []
            for key, piece, loss in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if state is None or state[0] != key:
                    if state is not None:
                        done.append(close(state))
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in read_turns(piece):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if loss:
                        state[3] += len(text)
                        state[4].update(text.encode("utf-8", "surrogatepass"))
                state[5] += len(piece)
            if done:
                yield flush(done)
        if state is not None:
            yield flush([close(state)])

    schema = (
        f"`{id_col}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    )
    return pieces.select(id_col, "piece", "loss").mapInArrow(run, schema)

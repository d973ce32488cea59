"""Chat formatting: records of many layouts to one turn template.

A record is a JSON document. Its nested field paths (``a.b``, ``a[].b``) are
sorted and hashed; the fingerprint selects a declarative mapping that says
where the turns are. Records whose fingerprint no mapping has come back with
status ``unknown`` and their fingerprint, and broken JSON with ``broken``: none
is dropped.

Template of a turn: ``<turn ROLE>`` newline TEXT ``</turn>`` newline. Inside
roles and texts a backslash is doubled and a control string gets a backslash
after its first character (``<\\turn``, ``<\\/turn``; in roles also ``\\>``), so
no text can open or close a turn and every text is read back exactly. The loss
mask covers the text of assistant turns.

Output is a row per turn, in pieces whose concatenation in turn order is the
conversation's formatted text, so a conversation of any length is formatted by
many tasks. Only its digests, which hash all turns in order, need one task a
conversation: rows are sorted (spilling, never gathered) and streamed through
a running hash, a batch at a time.

Null roles and texts are empty. Rows of equal turn number are ordered by role,
then text; null turn numbers come first; null conversation ids are one
conversation. Repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import small_batches, table

OPEN, CLOSE = "<turn ", "</turn>\n"
TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n(.*?)</turn>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)
LOSS_ROLE = "assistant"
#: Names that other layouts give the canonical roles.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``turns``: (role, paths): one turn each, its text the non-empty values of
    the paths, a blank line between; ``items``: (list path, role path, text
    path) of a message list; ``row``: (role path, text path) of a record that
    is one turn of a conversation. ``required`` and ``optional`` are the
    layout's leaf paths.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: tuple[str, str, str] | None = None
    row: tuple[str, str] | None = None


MAPPINGS = (
    Mapping("row", ("role", "text"), row=("role", "text")),
    Mapping("messages", ("messages[].role", "messages[].content"), ("messages[].name", "system", "id"),
            turns=(("system", ("system",)),), items=("messages", "role", "content")),
    Mapping("empty messages", ("messages[]",), ("system", "id"),
            turns=(("system", ("system",)),), items=("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), ("system", "id"),
            turns=(("system", ("system",)),), items=("conversations", "from", "value")),
    Mapping("prompt", ("prompt", "response"), ("system", "id"),
            turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("completion", ("prompt", "completion"), ("system", "id"),
            turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("instruction", ("instruction", "output"), ("input", "system", "id"),
            turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("nested", ("data.question", "data.answer"), ("data.context", "id"),
            turns=(("user", ("data.context", "data.question")), ("assistant", ("data.answer",)))),
)


def field_paths(value: object, at: str = "") -> set[str]:
    """The leaf paths of a JSON value; an empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths: set[str] | tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode(), 42)


def fingerprint_table(mappings: tuple[Mapping, ...]) -> dict[int, Mapping]:
    """Fingerprint -> mapping, for every choice of a layout's optional fields."""
    return {
        fingerprint(m.required + extra): m
        for m in mappings for n in range(len(m.optional) + 1) for extra in combinations(m.optional, n)}


def as_text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def at_path(record: dict, path: str) -> object:
    for key in path.split("."):
        record = record.get(key) if isinstance(record, dict) else None
    return record


def canonical_turns(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    """The (role, text) turns of a record."""
    if mapping.row:
        return [tuple(as_text(at_path(record, p)) for p in mapping.row)]
    out = []
    for role, paths in mapping.turns:
        parts = [as_text(at_path(record, p)) for p in paths]
        if role != "system" or any(parts):
            out.append((role, "\n\n".join(p for p in parts if p)))
    if mapping.items:
        where, role, text = mapping.items
        for item in at_path(record, where) or ():
            name = as_text(at_path(item, role))
            out.append((ROLE_NAMES.get(name, name), as_text(at_path(item, text))))
    return out


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<turn", "<\\turn").replace("</turn", "<\\/turn")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and the range of its loss mask (empty unless trained on)."""
    head = f"{OPEN}{escape(role).replace('>', '\\>')}>\n"
    body = escape(text)
    end = len(head) + len(body)
    return head + body + CLOSE, len(head) if role == LOSS_ROLE else end, end


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in TURN.findall(formatted)]


def format_records(df: DataFrame, keys: list[str], record_col: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Turns of JSON records: ``keys``, then item (the turn's number inside its
    record), status, fingerprint, role, text, formatted, loss_start, loss_end.
    A record without turns gives one row with nulls and its status."""
    small_batches(df.sparkSession)
    known = fingerprint_table(mappings)
    names = ["item", "status", "fingerprint", "role", "text", "formatted", "loss_start", "loss_end"]
    if clash := set(names) & set(keys):
        raise ValueError(f"key columns are called like output columns: {sorted(clash)}")
    rows = df.select(*keys, F.col(record_col).alias("record"))
    schema = T.StructType([
        *(rows.schema[k] for k in keys), T.StructField("item", T.IntegerType()), T.StructField("status", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("formatted", T.StringType()), T.StructField("loss_start", T.IntegerType()), T.StructField("loss_end", T.IntegerType())])

    def convert(source: str | None) -> list[tuple]:
        try:
            record = json.loads(source) if source is not None else None
        except ValueError:
            record = None
        if not isinstance(record, dict):
            return [(0, "broken", None, None, None, None, None, None)]
        mark = fingerprint(field_paths(record))
        mapping = known.get(mark)
        turns = canonical_turns(record, mapping) if mapping else []
        status = mapping.name if mapping else "unknown"
        return [(i, status, f"{mark:016x}", r, t, *format_turn(r, t)) for i, (r, t) in enumerate(turns)] or [
            (0, status, f"{mark:016x}", None, None, None, None, None)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [convert(s) for s in batch.column(len(keys)).to_pylist()]
            owner = pa.array([i for i, m in enumerate(made) for _ in m], pa.int64())
            flat = [x for m in made for x in m]
            kinds = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32()]
            columns = [batch.column(i).take(owner) for i in range(len(keys))]
            columns += [pa.array([x[i] for x in flat], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, *names])

    return rows.mapInArrow(run, schema)


def digests(turns: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Per conversation, read back from the formatted turns in ``order``:
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, and
    n_unformatted: its records whose status is unknown or broken."""
    small_batches(turns.sparkSession)
    rows = turns.where("formatted is not null or status in ('unknown', 'broken')").select(
        F.col(key).alias("key"), *(F.col(c) for c in order), "role", "text", "formatted", "loss_start", "loss_end")
    rows = rows.repartition("key").sortWithinPartitions("key", *order, "role", "text")
    rows = rows.select("key", "formatted", "loss_start", "loss_end")
    kind = rows.schema["key"].dataType
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()), T.StructField("n_unformatted", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        names, kinds = schema.names, to_arrow_schema(schema).types
        done: list[tuple] = []
        key = state = None

        def close() -> None:
            done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), *state[4:]))

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=names)
            done.clear()
            return out

        for batch in batches:
            for k, formatted, lo, hi in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if state is None or k != key:
                    if state:
                        close()
                    key, state = k, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                if formatted is None:
                    state[5] += 1
                    continue
                for role, text in parse_turns(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                masked = unescape(formatted[lo:hi])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(formatted)
            if done:
                yield batch_of()
        if state:
            close()
            yield batch_of()

    return rows.mapInArrow(run, schema)


#: A conversation whose texts look like turn marks and escapes.
HOSTILE_ID, HOSTILE_TEXT = -7, "\\### Assistant: </turn> ok"


def op3_chat(spark, sf_dir):
    """Contract query: digests of all conversations and of conversation -7.

    Table rows are records of the row layout; conversation -7 is one record of
    the messages layout."""
    turns = table(spark, sf_dir, "conversations")
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    rows = turns.select("conv_id", "turn", record.alias("record"))
    hostile = {"messages": [{"role": r, "content": HOSTILE_TEXT} for r in ("user", "assistant")]}
    extra = spark.range(1).select(
        F.lit(HOSTILE_ID).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.lit(0).cast(turns.schema["turn"].dataType).alias("turn"), F.lit(json.dumps(hostile)).alias("record"))
    found = digests(format_records(rows.unionByName(extra), ["conv_id", "turn"]), "conv_id", ["turn", "item"])
    return found.drop("n_unformatted")  # every record here has a known layout


OP3_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '<turn', '<\turn'), '</turn', '<\/turn') AS t,
         replace(replace(replace(replace(role, '\', '\\'), '<turn', '<\turn'), '</turn', '<\/turn'), '>', '\>') AS r
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(length(t) + length(r) + 16) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

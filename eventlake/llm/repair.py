"""Conversation structure repair: faults of every conversation, and the
cheapest edits that give it the role structure ``(s?(ua)+)?`` (``audit.py``).

A conversation's rows are read in order of turn, nulls first; rows of one turn
by role and then by the SHA-256 of their text, so equal rows stand together. A
row's first fault counts: blank (no character but ASCII white space), duplicate
(an earlier row has its role and text), truncated (the last such character ends
no sentence). Blank and duplicate rows have to be deleted; a truncated one costs
a little wherever it stays.

Which rows are first of their role and text is found by an aggregation over
(conversation, role, text digest), and each of them is marked by a small row
that is sorted before it; so no task keeps a set of the texts it has seen, and
a text that fills a third of all rows is aggregated before the shuffle. The
rows of a conversation then pass through one task, as the digest of its
repaired text hashes them one after another; they are streamed, and no more
than one batch of them and the open edits are held.

Null roles and texts are one space, so null texts are blank and a null role is
no valid one. A null turn comes first and counts in no gap; a null conv_id is a
conversation. Very long texts are hashed whole. Rows that repeat wholly are
duplicates of each other. A conversation whose rows are all dropped (``keep``)
has zeros, an empty audit and the hash of the empty string. Other columns are
not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.audit import Audit
from eventlake.llm.common import small_batches, table

INSIDE = re.compile(r"[^\x20\x09-\x0D]").search
WHITE = " \t\n\x0b\x0c\r"
PAIRS = {"su", "ua", "au"}
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Conversation:
    """Faults and repair of one conversation, from its sorted rows."""

    def __init__(self) -> None:
        self.audit = Audit()
        self.count = dict.fromkeys(FIELDS[1:5], 0)
        self.first: tuple | None = None
        self.turns, self.low, self.high = 0, None, None
        self.initial: str | None = None

    def mark(self, key: tuple) -> None:
        """The next row of this key is the first of its role and text."""
        self.first = key

    def take(self, turn: int | None, role: str, text: str, key: tuple) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = (turn if self.low is None else self.low), turn
        fault = None
        if not INSIDE(text):
            fault = "blank"
        elif self.first != key:
            fault = "duplicate"
        elif text.rstrip(WHITE)[-1] not in ".!?":
            fault = "truncated"
        if self.first == key:
            self.first = None
        if fault:
            self.count[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in PAIRS:
            self.count["illegal"] += 1
        self.initial = role[:1]
        self.audit.take(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit, digest = self.audit.result()
        return gaps, *self.count.values(), cost, audit, digest


def repair(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", keep: Column | None = None) -> DataFrame:
    """One row per conversation of ``df``: its id, the counts of ``FIELDS``,
    ``audit`` and ``repaired_sha256``. Rows for which ``keep`` is not true are
    dropped, but their conversation is reported."""
    small_batches(df.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    live = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    rows = df.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"),
                     space(text_col).alias("text"), live.alias("live"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    key = F.struct(F.col("turn").isNotNull().alias("dated"), "turn")
    firsts = (rows.where("live").groupBy("conv", "role", digest).agg(F.min(key).alias("at"))
              .select("conv", "at.turn", "role", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text")))
    dropped, kept = 1, 2
    body = rows.select("conv", "turn", "role", digest, F.when(F.col("live"), kept).otherwise(dropped).alias("kind"),
                       F.when(F.col("live"), F.col("text")).alias("text"))
    ordered = firsts.unionByName(body).repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest", "kind")
    schema = T.StructType([
        T.StructField(id_col, df.schema[id_col].dataType), *(T.StructField(f, T.LongType()) for f in FIELDS),
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        done: list[tuple] = []
        now, begun, conversation = None, False, None

        def out() -> pa.RecordBatch:
            columns = list(zip(*done)) or [[]] * len(arrow)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], names=arrow.names)

        for batch in batches:
            for conv, turn, role, sha, kind, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != now:
                    if begun:
                        done.append((now, *conversation.row()))
                    now, begun, conversation = conv, True, Conversation()
                if kind == 0:
                    conversation.mark((turn, role, sha))
                elif kind == kept:
                    conversation.take(turn, role, text, (turn, role, sha))
            yield out()
        if begun:
            done.append((now, *conversation.row()))
            yield out()

    return ordered.mapInArrow(run, schema)


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with the contract's damage by crc32 of ``conv_id:turn``:
    of 20 rows one loses its place (``lost``), one its text, one its sentence
    ends, one comes twice and one gets the user's role. Nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    times = F.when(kind == 3, 2).otherwise(1)
    return df.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(space("role")).alias("role"),
                     text.alias("text"), (kind == 0).alias("lost"), F.explode(F.array_repeat(F.lit(1), times)).alias("copy"))


def op13_repair(spark, sf_dir):
    """Contract query: damage all conversations, and report and repair them."""
    return repair(damaged(table(spark, sf_dir, "conversations")), keep=~F.col("lost"))

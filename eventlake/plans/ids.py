"""The ids that an append-only table holds, by hash bucket (SNK-1, SNK-3, UPS-3).

Beside bronze, silver and the facts stands a table of their event ids. A run
adds one folder with its own ids, dealt by hash over as many buckets as its rows
need (a power of two, ``BUCKET_ROWS`` ids each), sorted, with bloom filters.
Records name these folders like any others and tiers merge them, so there are
few, and a merged one has more buckets, not larger ones.

A batch is deduplicated against the buckets its own ids fall in, which are
known before the table is read: the reader is given their folders and nothing
else. A small batch so reads at most one bucket per id and folder, however long
the history is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators.dedupe import first_per_key

#: Ids of a bucket, at most about twice that many.
BUCKET_ROWS = 1 << 17
SCHEMA = T.StructType([T.StructField("event_id", T.StringType())])


def bucket_of(n: int) -> Column:
    """The bucket of ``event_id`` among ``n`` (a power of two)."""
    return F.pmod(F.xxhash64("event_id"), F.lit(n)).cast("int")


def buckets_for(rows: int, bucket_rows: int) -> int:
    return 1 << max(0, -(-rows // bucket_rows) - 1).bit_length()


class IdIndex:
    """The ids of one layer; ``entries`` below is the list of a record."""

    def __init__(self, wh, layer: str, bucket_rows: int = BUCKET_ROWS):
        self.wh = wh
        self.base = f"{layer}/ids"
        self.bucket_rows = bucket_rows

    @staticmethod
    def width(entries: Sequence[dict]) -> int:
        """Buckets that a batch has to tell apart."""
        return max((e["buckets"] for e in entries), default=1)

    @staticmethod
    def touched(width: int) -> Column:
        """An aggregate over a batch: the buckets of its ids."""
        return F.collect_set(bucket_of(width))

    def folders(self, entries: Sequence[dict], touched: Iterable[int], width: int) -> list[str]:
        """The folders of the buckets in which ids of ``touched`` can lie."""
        paths, touched = [], set(touched)
        for e in entries:
            n = e["buckets"]
            wanted = {t % n for t in touched} if n <= width else {b for b in range(n) if b % width in touched}
            wanted &= set(e["only"]) if "only" in e else wanted
            paths += [f"{e['path']}/bucket={b}" for b in sorted(wanted)]
        return paths

    def read(self, paths: Sequence[str]) -> DataFrame:
        spark = self.wh.spark
        return spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)

    def stored(self, entries: Sequence[dict], touched: Iterable[int], width: int) -> DataFrame:
        """The ids of the touched buckets."""
        return self.read(self.folders(entries, touched, width))

    def all(self, entries: Sequence[dict]) -> DataFrame:
        return self.stored(entries, [0], 1)

    def write(self, ids: DataFrame, rows: int, number: int) -> dict:
        """Write the ids of a batch or run; returns its entry."""
        n = buckets_for(rows, self.bucket_rows)
        path = self.wh.attempt(self.base)
        entry = {"path": path, "id": number, "rows": rows, "buckets": n}
        dealt = ids.select("event_id")
        option = ("parquet.bloom.filter.enabled#event_id", "true")
        if n == 1:
            dealt.coalesce(1).sortWithinPartitions("event_id").write.option(*option).parquet(f"{path}/bucket=0")
            return entry
        seen = Observation()
        dealt = dealt.withColumn("bucket", bucket_of(n)).repartition("bucket").sortWithinPartitions("bucket", "event_id")
        dealt.observe(seen, F.collect_set("bucket").alias("b")).write.option(*option).partitionBy("bucket").parquet(path)
        present = sorted(seen.get["b"])
        return entry if len(present) == n else {**entry, "only": present}

    def entries(self, state: dict, tables: Sequence[DataFrame]) -> list[dict]:
        """The index as ``state`` has it. A record from before there was one
        gets it made from ``tables``, which hold the layer's rows."""
        if "ids" in state:
            return state["ids"]
        ids = None
        for table in tables:
            one = table.select("event_id")
            ids = one if ids is None else ids.unionByName(one)
        rows = ids.count()
        return [self.write(ids, rows, 0)] if rows else []


def only_new(index: IdIndex, entries: Sequence[dict], rows: DataFrame, staging: str, order: Sequence[str]) -> DataFrame:
    """Insert-or-ignore: the rows whose id the index hasn't, the first of each
    id under ``order``.

    Only ids are compared. Those to leave out and those that repeat, of which
    an upstream layer lets through none as a rule, are written to ``staging``
    and counted: where there are none the rows pass as they are, and otherwise
    the planner knows how few they are.
    """
    spark = rows.sparkSession
    ids, width = rows.select("event_id"), index.width(entries)
    out = ids.groupBy("event_id").count().where("count > 1").select("event_id", F.lit("repeated").alias("why"))
    if entries:
        touched = [0] if width == 1 else [r[0] for r in ids.select(bucket_of(width)).distinct().collect()]
        stored = index.stored(entries, touched, width)
        out = out.unionByName(stored.join(ids, "event_id", "left_semi").distinct().withColumn("why", F.lit("stored")))
    seen = Observation(f"new_{uuid.uuid4().hex[:12]}")
    out.observe(seen, F.count_if(F.col("why") == "stored").alias("stored"), F.count_if(F.col("why") == "repeated").alias("repeated")).write.parquet(staging)
    found = spark.read.schema(out.schema).parquet(staging)
    if seen.get["stored"]:
        rows = rows.join(found.where("why = 'stored'").select("event_id"), "event_id", "left_anti")
    if seen.get["repeated"]:
        repeated = found.where("why = 'repeated'").select("event_id")
        first = first_per_key(rows.join(repeated, "event_id", "left_semi"), ["event_id"], list(order))
        rows = rows.join(repeated, "event_id", "left_anti").unionByName(first)
    return rows


"""Warehouse layout, published state and table readers.

Layout under one root (a shared folder on a cluster)::

  landing/                            raw event text
  bronze/raw_events/attempt=X/        bronze, insert-or-ignore on event_id
  bronze/dead_letter_queue/attempt=X/ rejected lines with their reason
  bronze/batch_reports/attempt=X/     inserted / duplicates / errors
  {bronze,silver,gold}/ids/attempt=X/bucket=B/   the event ids of the layer's rows
  silver/events/attempt=X/            typed events (payload as VARIANT)
  silver/rejects/attempt=X/           bronze rows kept out of silver
  gold/dim_date/attempt=X/            calendar
  gold/dim_{actors,repos,event_types}/attempt=X/bucket=B/   hash buckets of a dimension
  gold/fact_events/attempt=X/date_id=D/                     facts loaded by a run
  gold/rollups/attempt=X/kind=K/      aggregates of the facts loaded by a run
  gold/run_metrics/attempt=X/         per-run report
  {bronze,silver,gold}/_log/<N>.json  commit records

Every write goes to a folder of its own attempt, named by nothing but its
layer's commit record, and nothing is written to a folder twice. The newest
record of a layer is its whole published state: for each table the list of
``{path, id, rows}`` that make it up (``id`` is the batch or run), for a
dimension one such entry per bucket. A failed, lost or concurrent attempt is
in no record and never seen. ``merge_tiers`` replaces neighbours in a list by
one entry, ``compact`` a whole list.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import schema as S
from eventlake.plans import rollups as R
from eventlake.plans.ids import BUCKET_ROWS, IdIndex
from eventlake.plans.storage import CommitLog, FileSystem
from eventlake.sources import seeds

BRONZE_TABLES = ("raw_events", "dead_letter_queue", "batch_reports")
SILVER_TABLES = ("events", "rejects")


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    names = {f.name for f in schema.fields}
    return T.StructType(list(schema.fields) + [f for f in fields if f.name not in names])


BATCH_ID = T.StructField("batch_id", T.IntegerType(), True)
RUN_ID = T.StructField("run_id", T.IntegerType(), True)
ATTEMPT = T.StructField("attempt", T.StringType(), True)
BUCKET = T.StructField("bucket", T.IntegerType(), True)

DIM_TABLES = {
    "dim_actors": S.DIM_ACTORS,
    "dim_repos": S.DIM_REPOS,
    "dim_event_types": S.DIM_EVENT_TYPES,
}
DIM_KEYS = {"dim_actors": "actor_id", "dim_repos": "repo_id", "dim_event_types": "event_type"}
#: Hash buckets of a growing dimension when a warehouse is made, and the rows of
#: a bucket above which it gets more, one split at a time (``plans/gold.py``).
DIM_BUCKETS = 8
DIM_BUCKET_ROWS = 20_000

BATCH_REPORTS = T.StructType([
    T.StructField("fetched", T.LongType()), T.StructField("inserted", T.LongType()),
    T.StructField("duplicates", T.LongType()), T.StructField("errors", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()), BATCH_ID])
SILVER_REJECTS = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("batch_id", T.IntegerType()), T.StructField("processed_at", T.TimestampType()), RUN_ID])


class Warehouse:
    """``id_bucket_rows``: ids of an index bucket (``plans/ids.py``); it may
    differ from call to call."""

    def __init__(self, spark: SparkSession, root: str, id_bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = FileSystem(spark, self.root)
        self.bronze_log = CommitLog(self.fs, self.path("bronze/_log"))
        self.silver_log = CommitLog(self.fs, self.path("silver/_log"))
        self.gold_log = CommitLog(self.fs, self.path("gold/_log"))
        self.bronze_ids, self.silver_ids, self.fact_ids = (IdIndex(self, x, id_bucket_rows) for x in ("bronze", "silver", "gold"))

    def path(self, rel: str) -> str:
        return f"{self.root}/{rel}"

    def attempt(self, table: str) -> str:
        """A folder for one attempt at writing ``table`` (e.g. ``silver/events``)."""
        return self.path(f"{table}/attempt={uuid.uuid4().hex}")

    # -- bronze -----------------------------------------------------------
    def bronze_state(self) -> dict:
        return self.bronze_log.latest() or {"version": 0, "batch_id": 0, "streams": {}, "ids": [], **{t: [] for t in BRONZE_TABLES}}

    def bronze_events(self, after: int = 0, state: dict | None = None) -> DataFrame:
        """Committed bronze rows of batches above ``after``, with ``batch_id``."""
        entries = (state or self.bronze_state())["raw_events"]
        return self._read("bronze/raw_events", with_fields(S.BRONZE_RAW_EVENTS, BATCH_ID), entries, after=after, id_col="batch_id")

    def dead_letters(self) -> DataFrame:
        return self._read("bronze/dead_letter_queue", with_fields(S.BRONZE_DEAD_LETTER, BATCH_ID), self.bronze_state()["dead_letter_queue"])

    def bronze_reports(self) -> DataFrame:
        return self._read("bronze/batch_reports", BATCH_REPORTS, self.bronze_state()["batch_reports"])

    # -- silver -----------------------------------------------------------
    def silver_state(self) -> dict:
        return self.silver_log.latest() or {"version": 0, "run_id": 0, "bronze_batch": 0, "processed_at": None, "ids": [], **{t: [] for t in SILVER_TABLES}}

    def silver_events(self, upto: int | None = None, after: int = 0) -> DataFrame:
        """Silver rows of committed runs ``after < run_id <= upto``, with run_id."""
        return self._read("silver/events", with_fields(S.SILVER_EVENTS, RUN_ID), self.silver_state()["events"], after, upto, "run_id")

    def silver_rejects(self, upto: int | None = None) -> DataFrame:
        return self._read("silver/rejects", SILVER_REJECTS, self.silver_state()["rejects"], 0, upto, "run_id")

    def silver_mark(self, run_id: int) -> int:
        """The last bronze batch that silver had processed after a run."""
        return self.silver_log.of_run(run_id)["bronze_batch"] if run_id else 0

    # -- gold -------------------------------------------------------------
    def gold_state(self) -> dict | None:
        return self.gold_log.latest()

    def published(self) -> dict:
        state = self.gold_state()
        if state is None:
            raise RuntimeError(f"warehouse {self.root} is not bootstrapped")
        return state

    def published_run(self) -> int:
        return int(self.published()["run_id"])

    def dim_date(self) -> DataFrame:
        return self.spark.read.parquet(self.published()["dim_date"])

    def dim(self, name: str, run_id: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """A dimension as published now or by ``run_id``; only some of its
        buckets if they are given."""
        state = self.published() if run_id is None else self.gold_log.of_run(run_id)
        entries = [e for e in state["dims"][name] if buckets is None or e["id"] in buckets]
        return self._read(f"gold/{name}", DIM_TABLES[name], entries, leaf="bucket")

    def facts(self, state: dict | None = None) -> DataFrame:
        """Published facts, with ``run_id``."""
        entries = (state or self.published())["fact_events"]
        return self._read("gold/fact_events", with_fields(S.FACT_EVENTS, RUN_ID), entries)

    def _rollups(self, kind: str, columns: list[str]) -> DataFrame | None:
        """Rows of all runs as they were written; None for a record from before
        runs wrote any."""
        state = self.published()
        if "rollups" not in state:
            return None
        return self._read("gold/rollups", R.ROLLUPS, state["rollups"]).where(F.col("kind") == kind).select(columns)

    def hours(self) -> DataFrame:
        """Events per (date, hour, type) and run (``plans/rollups.py``)."""
        rows = self._rollups("hours", R.HOURS)
        return R.hours(self.facts()) if rows is None else rows

    def distinct_ids(self) -> DataFrame:
        """Bitmaps of the actors and repos per date and run."""
        rows = self._rollups("ids", R.IDS)
        return R.ids(self.facts()) if rows is None else rows

    def calendar(self, state: dict | None = None) -> tuple[int, int]:
        """The first and last date_id of dim_date, which has every day between."""
        state = state or self.published()
        if "calendar" in state:
            return tuple(state["calendar"])
        return tuple(self.spark.read.parquet(state["dim_date"]).agg(F.min("date_id"), F.max("date_id")).first())

    def run_metrics(self) -> DataFrame:
        from eventlake.plans.gold import RUN_METRICS
        return self._read("gold/run_metrics", with_fields(RUN_METRICS, RUN_ID), self.published()["run_metrics"])

    # -- helpers ----------------------------------------------------------
    def _read(self, table: str, schema: T.StructType, entries: list[dict], after: int = 0,
              upto: int | None = None, id_col: str | None = None, leaf: str | None = None) -> DataFrame:
        """The rows of a record's entries with ``after < id <= upto``. An entry
        that compaction made covers the ids from ``first`` to ``id``, so the
        bounds are also applied to ``id_col``. No entries: an empty frame."""
        wanted = [e for e in entries if e["id"] > after and (upto is None or e.get("first", e["id"]) <= upto)] if id_col else entries
        if not wanted:
            return seeds.empty(self.spark, schema)
        paths = [f"{e['path']}/{leaf}={e['id']}" if leaf else e["path"] for e in wanted]
        rows = self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths).select(schema.names)
        if id_col and any("first" in e for e in wanted):
            rows = rows.where(f"{id_col} > {after}" + (f" AND {id_col} <= {upto}" if upto is not None else ""))
        return rows

    def register_views(self) -> None:
        """Temp views for SQL users over the published state:
        bronze_raw_events, dead_letter_queue, batch_reports, silver_events,
        silver_rejects, v_events, dim_date, dim_actors, dim_repos,
        dim_event_types, fact_events, run_metrics. (Layer prefixes are
        dropped.)"""
        from eventlake.operators.conform import conform
        self.bronze_events().createOrReplaceTempView("bronze_raw_events")
        self.dead_letters().createOrReplaceTempView("dead_letter_queue")
        self.bronze_reports().createOrReplaceTempView("batch_reports")
        silver = self.silver_events()
        silver.createOrReplaceTempView("silver_events")
        self.silver_rejects().createOrReplaceTempView("silver_rejects")
        conform(silver).createOrReplaceTempView("v_events")
        self.dim_date().createOrReplaceTempView("dim_date")
        for name in DIM_TABLES:
            self.dim(name).createOrReplaceTempView(name)
        self.facts().createOrReplaceTempView("fact_events")
        self.run_metrics().createOrReplaceTempView("run_metrics")


def lit_ts(value) -> F.Column:
    """A timestamp literal from a datetime or ``yyyy-MM-dd HH:mm:ss`` text."""
    if isinstance(value, str):
        return F.to_timestamp(F.lit(value))
    return F.lit(value).cast("timestamp")

"""Bronze ingest (SNK-1, SNK-2, DED-1, REJ-1, H-6).

One call ingests raw lines as the next batch:

  classify -> a staging table ... rejects ............ dead_letter_queue
                              ... accepted -> first arrival per id
                                  -> minus ids already stored ... raw_events

and commits one record that names the batch's folders. Batches are
numbered in commit order without gaps, so a reader's mark on the number leaves
nothing behind. A caller that may repeat itself
names its batch: a stream by (stream id, epoch), others by a label; a name that
is committed already returns its report and writes nothing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.operators.classify import classify
from eventlake.operators.dedupe import first_arrival
from eventlake.operators.merge import insert_ignore
from eventlake.operators.parallel import spread
from eventlake.plans.concurrent import run_concurrently
from eventlake.plans.storage import CommitConflict
from eventlake.plans.warehouse import BATCH_REPORTS, Warehouse, lit_ts
from eventlake.session import describe
from eventlake.sources.landing import ARRIVAL

REPORT = ("batch_id", "fetched", "inserted", "duplicates", "errors")


def _label_file(wh: Warehouse, label: object) -> str:
    return wh.path(f"bronze/_labels/{hashlib.sha256(str(label).encode()).hexdigest()}.json")


def committed_report(wh: Warehouse, label: object = None, stream: tuple[str, int] | None = None) -> dict | None:
    """The report of a batch committed under this name, if there is one.

    A label's file is written right after its commit; a writer lost in between
    is found by the newest record, which carries the label.
    """
    state = wh.bronze_state()
    if stream is not None and state["streams"].get(stream[0], -1) >= stream[1]:
        return {**state["report"], "repeated": True} if state.get("stream") == list(stream) else {"repeated": True}
    if label is not None:
        if state.get("label") == str(label):
            return {**state["report"], "repeated": True}
        if wh.fs.exists(_label_file(wh, label)):
            return {**json.loads(wh.fs.read_text(_label_file(wh, label))), "repeated": True}
    return None


def ingest_batch(
    wh: Warehouse,
    raw: DataFrame,
    batch_id: int | str | None = None,
    now: dt.datetime | str | None = None,
    arrival: tuple[str, ...] = ARRIVAL,
    stream: tuple[str, int] | None = None,
) -> dict:
    """Ingest raw lines (``value`` + arrival columns) as the next bronze batch.

    ``batch_id`` is the caller's label of the batch and ``stream`` a stream's
    (id, epoch); either makes a repeated call a no-op. Returns the report:
    the committed batch number, fetched, inserted, duplicates, errors. A
    duplicate is an accepted line whose id arrived earlier in this batch or in
    any stored batch; the first arrival always wins. If another writer
    commits first, the batch is compared with the store again.

    The parsed lines are written once to a staging folder next to the tables
    and read by every later step, so nothing is parsed twice or kept in
    executor memory.
    """
    spark = wh.spark
    if (known := committed_report(wh, batch_id, stream)) is not None:
        return known
    if not set(arrival) <= set(raw.columns):
        # Plain ``value`` rows (e.g. an in-memory hand-off): their order as
        # given is the arrival order, taken before any shuffle.
        raw = raw.select("value", F.lit("").alias(arrival[0]),
                         F.monotonically_increasing_id().alias(arrival[1]))
    ts = lit_ts(now) if now is not None else lit_ts(dt.datetime.now(dt.timezone.utc))
    describe(spark, "bronze: parse")
    staging = wh.attempt("bronze/_staging")
    # The line itself is kept for the rejects only.
    parsed = classify(spread(raw)).withColumns({
        "value": F.when(F.col("reject_reason").isNotNull(), F.col("value")), "ingested_at": ts})
    seen = Observation(f"bronze_in_{uuid.uuid4().hex[:12]}")
    # The buckets of the batch's ids are learnt from the pass that parses it.
    width = wh.bronze_ids.width(wh.bronze_state().get("ids", []))
    parsed.observe(seen, F.count(F.lit(1)).alias("fetched"),
                   F.count_if(F.col("reject_reason").isNotNull()).alias("errors"),
                   wh.bronze_ids.touched(width).alias("touched")).write.parquet(staging)
    fetched, errors = int(seen.get["fetched"]), int(seen.get["errors"])
    touched = (seen.get["touched"], width)
    lines = spark.read.schema(parsed.schema).parquet(staging)
    try:
        while True:
            state = wh.bronze_state()
            try:
                return _commit(wh, lines, fetched, errors, state, ts, arrival, batch_id, stream, touched)
            except CommitConflict:
                if (known := committed_report(wh, batch_id, stream)) is not None:
                    return known
    finally:
        wh.fs.delete(staging)


def _commit(wh: Warehouse, lines: DataFrame, fetched: int, errors: int, state: dict, ts, arrival, label, stream,
            touched: tuple[list[int], int]) -> dict:
    """Write the batch that follows ``state`` and commit it."""
    spark = wh.spark
    n = state["batch_id"] + 1
    paths = {t: wh.attempt(f"bronze/{t}") for t in ("raw_events", "dead_letter_queue", "batch_reports")}

    def write_rejects() -> None:
        lines.filter(F.col("reject_reason").isNotNull()).select(
            F.col("value").alias("failed_payload"),
            F.col("reject_reason").alias("error_message"),
            F.col("ingested_at").alias("created_at"),
            F.lit(n).alias("batch_id"),
        ).write.parquet(paths["dead_letter_queue"])

    known = wh.bronze_ids.entries(state, [wh.bronze_events(state=state)])

    def write_raw() -> tuple[int, list[dict]]:
        accepted = lines.filter(F.col("reject_reason").isNull())
        first = first_arrival(accepted, "event_id", list(arrival))
        if known:
            first = insert_ignore(wh.bronze_ids.stored(known, *touched), first, ["event_id"], key_source=accepted)
        wrote = Observation(f"bronze_out_{uuid.uuid4().hex[:12]}")
        (first.select("event_id", "event_type", "full_json", "ingested_at", F.lit(n).alias("batch_id"))
         .sortWithinPartitions("event_id")
         .observe(wrote, F.count(F.lit(1)).alias("inserted"))
         .write.option("parquet.bloom.filter.enabled#event_id", "true").parquet(paths["raw_events"]))
        inserted = int(wrote.get["inserted"])
        if not inserted:
            return 0, known
        stored = spark.read.schema(S.BRONZE_RAW_EVENTS).parquet(paths["raw_events"])
        return inserted, [*known, wh.bronze_ids.write(stored, inserted, n)]

    jobs = {"raw events": write_raw}
    if errors:
        jobs["dead letters"] = write_rejects
    inserted, ids = run_concurrently(spark, f"bronze {n}", jobs)["raw events"]
    report = dict(zip(REPORT, (n, fetched, inserted, fetched - errors - inserted, errors)))
    describe(spark, f"bronze {n}: report")
    spark.createDataFrame([(*(report[c] for c in REPORT[1:]), None, n)], BATCH_REPORTS).withColumn(
        "ingested_at", ts).write.parquet(paths["batch_reports"])
    rows = {"raw_events": inserted, "dead_letter_queue": errors, "batch_reports": 1}
    record = {**state, "batch_id": n, "report": report, "ids": ids, "label": None if label is None else str(label),
              "stream": None if stream is None else list(stream)}
    for table, count in rows.items():
        if count:
            record[table] = [*state[table], {"path": paths[table], "id": n, "rows": count}]
    if stream is not None:
        record["streams"] = {**state["streams"], stream[0]: stream[1]}
    wh.bronze_log.commit(state, record)
    if label is not None:
        wh.fs.mkdirs(wh.path("bronze/_labels"))
        wh.fs.write_text(_label_file(wh, label), json.dumps(report), overwrite=True)
    return report


def backlog(wh: Warehouse, silver_upto: int | None = None) -> DataFrame:
    """JOIN-1 / H-2: bronze rows that silver has neither loaded nor rejected,
    as ``(batch_id, event_id)``.

    Batches are numbered without gaps and a silver run takes all of those above
    the mark of the run before, so the backlog is what lies above the mark: its
    batches are read and nothing else. ``unprocessed`` checks it row by row.
    """
    mark = wh.silver_state()["bronze_batch"] if silver_upto is None else wh.silver_mark(silver_upto)
    return wh.bronze_events(after=mark).select("batch_id", "event_id")


def unprocessed(wh: Warehouse, silver_upto: int | None = None) -> DataFrame:
    """The backlog as a NOT EXISTS anti-join on event_id over the whole tables,
    both narrowed to the id column first: a check of the marks."""
    bronze = wh.bronze_events().select("batch_id", "event_id")
    done = wh.silver_events(silver_upto).select("event_id").unionByName(
        wh.silver_rejects(silver_upto).select("event_id"))
    return bronze.join(done, "event_id", "left_anti")

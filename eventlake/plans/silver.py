"""Silver run (SRC-3, PRJ-2, FLT-1, DED-2, SNK-3).

A run reads every bronze batch above the mark of the last committed run (batch
numbers are dense and committed in order, so none is left behind), extracts
the typed columns, keeps the first row of an event_id and only ids that silver
has neither loaded nor rejected (by its id index), and writes events, rejects
and their ids to folders of its own attempt. Then it commits one record. A failed run commits nothing, and
its retry reads the same batches.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.operators.extract import extract
from eventlake.operators.parallel import spread
from eventlake.plans.ids import only_new
from eventlake.plans.warehouse import Warehouse, lit_ts
from eventlake.session import describe

SILVER_COLUMNS = [f.name for f in S.SILVER_EVENTS.fields]


def _as_datetime(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
    return dt.datetime.fromisoformat(str(value)).replace(tzinfo=dt.timezone.utc)


def run_silver(wh: Warehouse, now: dt.datetime | str) -> dict:
    """Process the bronze backlog once. ``now`` stamps ``processed_at`` and
    must be later than the previous run's, which keeps gold's strict
    ``processed_at > watermark`` filter exact."""
    state, bronze_state = wh.silver_state(), wh.bronze_state()
    now_dt = _as_datetime(now)
    if state["processed_at"] and now_dt <= _as_datetime(state["processed_at"]):
        raise ValueError(f"processed_at {now_dt} is not after {state['processed_at']}")
    if bronze_state["batch_id"] <= state["bronze_batch"]:
        return {"run_id": state["run_id"], "loaded": 0, "rejected": 0, "skipped": True}

    run_id = state["run_id"] + 1
    describe(wh.spark, f"silver {run_id}: events")
    bronze = wh.bronze_events(after=state["bronze_batch"], state=bronze_state)
    paths = {t: wh.attempt(f"silver/{t}") for t in ("events", "rejects")}
    staging = wh.attempt("silver/_staging")
    known = wh.silver_ids.entries(state, [wh.silver_events(), wh.silver_rejects()])
    new = only_new(wh.silver_ids, known, spread(bronze), staging, ["batch_id ASC", "ingested_at ASC"])
    # Not cached: the rejects are a second consumer only when a row was
    # rejected (rare), and then they are recomputed from the bronze batch.
    # The observe() node also keeps Catalyst from pushing the accept filter
    # below the staged extraction.
    rows = extract(new.withColumnRenamed("event_id", "stored_id")).withColumns(
        {"processed_at": lit_ts(now_dt), "run_id": F.lit(run_id)})
    seen = Observation(f"silver_{uuid.uuid4().hex[:12]}")
    good = rows.observe(
        seen, F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("silver_reject_reason").isNotNull()).alias("bad"),
    ).filter(F.col("silver_reject_reason").isNull()).select(*SILVER_COLUMNS, "run_id")
    good.write.parquet(paths["events"])
    counts = seen.get
    loaded, rejected = int(counts["n"] - counts["bad"]), int(counts["bad"])
    if rejected:
        describe(wh.spark, f"silver {run_id}: rejects")
        rows.filter(F.col("silver_reject_reason").isNotNull()).select(
            F.col("stored_id").alias("event_id"), F.col("silver_reject_reason").alias("reason"),
            "batch_id", "processed_at", "run_id").write.parquet(paths["rejects"])
    written = [wh.spark.read.schema(S.SILVER_EVENTS).parquet(paths["events"]).select("event_id")]
    if rejected:
        written.append(wh.spark.read.schema("event_id string").parquet(paths["rejects"]))
    if loaded + rejected:
        known = [*known, wh.silver_ids.write(reduce(DataFrame.unionByName, written), loaded + rejected, run_id)]
    wh.fs.delete(staging)
    record = {**state, "run_id": run_id, "ids": known, "bronze_batch": bronze_state["batch_id"],
              "processed_at": now_dt.strftime("%Y-%m-%d %H:%M:%S.%f")}
    for table, count in (("events", loaded), ("rejects", rejected)):
        if count:
            record[table] = [*state[table], {"path": paths[table], "id": run_id, "rows": count}]
    wh.silver_log.commit(state, record)
    return {"run_id": run_id, "loaded": loaded, "rejected": rejected, "skipped": False}

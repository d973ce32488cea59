"""PUB-2 / STR-2: the scheduled silver + gold run, and snapshot retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from eventlake import schema as S
from eventlake.plans import rollups as R
from eventlake.plans.layout import clustered
from eventlake.plans.gold import RUN_METRICS, run_gold
from eventlake.plans.silver import run_silver
from eventlake.plans.storage import CommitConflict, CommitLog
from eventlake.plans.tiers import FANOUT, due, merged_entry, put, tier
from eventlake.plans.warehouse import BATCH_ID, BATCH_REPORTS, RUN_ID, SILVER_REJECTS, Warehouse, with_fields

RAW_EVENTS, DEAD_LETTERS = with_fields(S.BRONZE_RAW_EVENTS, BATCH_ID), with_fields(S.BRONZE_DEAD_LETTER, BATCH_ID)
SILVER_EVENTS, FACTS, RUN_METRIC_ROWS = (with_fields(x, RUN_ID) for x in (S.SILVER_EVENTS, S.FACT_EVENTS, RUN_METRICS))


def run_pipeline(wh: Warehouse, now: dt.datetime | str,
                 gold_now: dt.datetime | str | None = None) -> dict:
    """Silver, then gold only if silver succeeded (an exception stops it).

    Meant for a scheduler (cron, an orchestrator, or a ``foreachBatch`` of a
    stream over bronze); the streaming bronze ingest runs independently. Folders
    whose tier is full are merged afterwards.
    """
    silver = run_silver(wh, now)
    gold = run_gold(wh, gold_now or now)
    return {"silver": silver, "gold": gold, "merged": merge_tiers(wh)}


def vacuum(wh: Warehouse, keep_runs: int = 2) -> list[str]:
    """Delete dimension buckets that none of the newest ``keep_runs`` published
    runs names. Only folders that an older record names are candidates, so
    those of a run in flight are safe; facts, metrics and records stay.
    Returns the removed paths."""
    if keep_runs < 1:
        raise ValueError("keep_runs must be at least 1: readers need the published run")
    log, published = wh.gold_log, wh.published()
    files = lambda v: {f"{e['path']}/bucket={e['id']}" for d in log.get(v)["dims"].values() for e in d}
    done_file = wh.path("gold/_log/_vacuumed")
    first = int(wh.fs.read_text(done_file)) if wh.fs.exists(done_file) else 0
    cutoff = published["version"]
    while cutoff > first and log.get(cutoff - 1)["run_id"] > published["run_id"] - keep_runs:
        cutoff -= 1
    kept = set().union(*(files(v) for v in range(cutoff, published["version"] + 1)))
    removed = sorted(set().union(*(files(v) for v in range(first, cutoff))) - kept)
    for path in removed:
        wh.fs.delete(path)
    wh.fs.write_text(done_file, str(cutoff), overwrite=True)
    return removed


def _tables(wh: Warehouse) -> dict[str, tuple[CommitLog, dict[str, Callable[[list[dict]], DataFrame]]]]:
    """The append-only tables of each layer, with readers of some of their folders."""
    read = lambda base, schema: lambda entries: wh._read(base, schema, entries)
    return {
        "bronze": (wh.bronze_log, {"raw_events": read("bronze/raw_events", RAW_EVENTS), "batch_reports": read("bronze/batch_reports", BATCH_REPORTS),
                                   "dead_letter_queue": read("bronze/dead_letter_queue", DEAD_LETTERS), "ids": wh.bronze_ids.all}),
        "silver": (wh.silver_log, {"events": read("silver/events", SILVER_EVENTS), "rejects": read("silver/rejects", SILVER_REJECTS),
                                   "ids": wh.silver_ids.all}),
        "gold": (wh.gold_log, {"fact_events": read("gold/fact_events", FACTS), "run_metrics": read("gold/run_metrics", RUN_METRIC_ROWS),
                               "ids": wh.fact_ids.all, "rollups": read("gold/rollups", R.ROLLUPS)}),
    }


def _merge(wh: Warehouse, layer: str, table: str, rows: DataFrame, old: list[dict], level: int) -> dict:
    """Write the rows of some folders as one.

    Bronze is written in order of event_id, and facts by date and inside a date
    by repo and actor together (``plans/layout.py``), so the statistics of files
    and row groups tell where an id, a repo or an actor can be; ids go to the
    buckets that their number asks for.
    """
    if table == "ids":
        index = {"bronze": wh.bronze_ids, "silver": wh.silver_ids, "gold": wh.fact_ids}[layer]
        made = index.write(rows, sum(e["rows"] for e in old), old[-1]["id"])
        return {**made, **merged_entry(old, made["path"], level)}
    path = wh.attempt(f"{layer}/{table}")
    if table == "raw_events":
        rows = rows.repartitionByRange("event_id").sortWithinPartitions("event_id")
        rows.write.option("parquet.bloom.filter.enabled#event_id", "true").parquet(path)
    elif table == "fact_events":
        clustered(rows, sum(e["rows"] for e in old)).write.partitionBy("date_id").parquet(path)
    elif table == "rollups":
        R.write(R.merged(rows), path)
    else:
        rows.write.parquet(path)
    return merged_entry(old, path, level)


def _replace(wh: Warehouse, choose: Callable[[list[dict]], tuple[int, int] | None]) -> dict[str, int]:
    """Merge, in every append-only table, the entries from the place that
    ``choose`` gives on, into one of the tier it gives. Returns the folders
    merged by table.

    Readers of older records keep their folders; nothing is deleted here.
    Commits made meanwhile are kept: on a conflict the merged part replaces the
    same entries of the newer record, and is dropped if these are gone, as
    another merge has taken some of them.
    """
    merged = {}
    for layer, (log, tables) in _tables(wh).items():
        state = log.latest()
        if state is None:
            continue
        new: dict[str, tuple[list[dict], dict]] = {}
        for table, read in tables.items():
            entries = state.get(table, [])
            chosen = choose(entries)
            if chosen is None or len(entries) - chosen[0] < 2:
                continue
            old = entries[chosen[0] :]
            new[table] = (old, _merge(wh, layer, table, read(old), old, chosen[1]))
        while new:
            latest = log.latest()
            lists = {t: put(latest[t], old, e) for t, (old, e) in new.items()}
            new = {t: x for t, x in new.items() if lists[t] is not None}
            if not new:
                break
            try:
                log.commit(latest, {**latest, **{t: lists[t] for t in new}})
            except CommitConflict:
                continue
            merged |= {f"{layer}/{t}": len(old) for t, (old, _) in new.items()}
            break
    return merged


def merge_tiers(wh: Warehouse, fanout: int = FANOUT) -> dict[str, int]:
    """Keep every table's list of folders short (``plans/tiers.py``): cheap to
    call after each run, as it does nothing until ``fanout`` folders of a tier
    are there, and a row is rewritten once per tier only."""
    return _replace(wh, lambda entries: due(entries, fanout))


def compact(wh: Warehouse) -> dict[str, int]:
    """Merge the folders of every append-only table into one each, whatever
    their tiers: a full rewrite, for a table that is to be read often or kept."""
    return _replace(wh, lambda entries: (0, max(tier(e) for e in entries) + 1) if len(entries) > 1 else None)

"""Upsert / insert-only helpers for Parquet tables without MERGE INTO.

The dimension helpers return the *complete* next version of a table plus
an ``__action`` column (insert / update / keep) so affected-row counts
(AGG-8) can be observed while the new version is written.

Scale: ``insert_ignore`` guards append-only tables (bronze, silver, facts)
that grow without bound while each batch stays small. The batch's keys meet
the table's key column in a semi-join, whose result is at most the batch: if
the planner sees from the written batch's size that its keys fit a broadcast,
the table is only scanned, never shuffled; otherwise both are shuffled by key.
The rule and the answer are the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "__action"
INSERT, UPDATE, KEEP = "insert", "update", "keep"

def insert_ignore(table: DataFrame, batch: DataFrame, keys: Sequence[str],
                  key_source: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``table`` (ON CONFLICT DO NOTHING),
    one row per key of the batch being the caller's business.

    Returns only the new rows: an append-only table writes just these.
    ``key_source`` holds the same key set as ``batch`` when that is cheaper
    to compute, so the batch's own plan is evaluated once.
    """
    batch_keys = (batch if key_source is None else key_source).select(*keys)
    present = table.select(*keys).join(batch_keys, list(keys), "left_semi").distinct()
    return batch.join(present, list(keys), "left_anti")


def _with_now(df: DataFrame, now: Column | str) -> DataFrame:
    return df.selectExpr("*", f"{now} AS __now") if isinstance(now, str) else df.withColumn("__now", now)


def upsert_if_newer(
    table: DataFrame,
    batch: DataFrame,
    key: str,
    now: Column | str,
    time_col: str = "last_event_time",
    stamp_col: str = "updated_at",
) -> DataFrame:
    """UPS-1: insert new keys; replace a row only when the batch row is newer.

    The guard is strict: an equal or NULL stored time keeps the stored row,
    so a late event can never regress a dimension. ``batch`` must hold at
    most one row per key (see ``latest_by_key``) and the table's columns
    except ``stamp_col``. Updated and inserted rows get ``stamp_col = now``
    (a Column or SQL text).

    One full-outer join on the key. Keys are unique on both sides, so the
    join cannot skew; the snapshot is read and rewritten whole anyway, and
    AQE sizes (or broadcasts) the shuffle from runtime statistics.
    """
    cols = table.columns
    t = table.selectExpr(*[f"`{c}` AS t_{c}" for c in cols])
    n = batch.selectExpr(*[f"`{c}` AS n_{c}" for c in cols if c != stamp_col])
    joined = _with_now(t.join(n, F.expr(f"t_{key} = n_{key}"), "full_outer"), now)
    acted = joined.selectExpr(
        "*",
        f"CASE WHEN t_{key} IS NULL THEN '{INSERT}' "
        f"WHEN n_{key} IS NOT NULL AND t_{time_col} < n_{time_col} THEN '{UPDATE}' "
        f"ELSE '{KEEP}' END AS {ACTION}")

    def pick(c: str) -> str:
        if c == key:
            return f"coalesce(t_{c}, n_{c}) AS {c}"
        new = "__now" if c == stamp_col else f"n_{c}"
        return f"CASE WHEN {ACTION} = '{KEEP}' THEN t_{c} ELSE {new} END AS {c}"

    return acted.selectExpr(*[pick(c) for c in cols], ACTION)


def insert_new_types(
    table: DataFrame, seen_types: DataFrame, now: Column | str, exclude: str
) -> DataFrame:
    """UPS-2: auto-discover event types not yet in the dimension.

    ``seen_types`` is one ``event_type`` column; it is de-duplicated with a
    partial (map-side) aggregate first, so only distinct types shuffle. New
    types get category ``Unknown``, label = type, not core, not curated.
    The join strategy is left to the planner: the dimension is a few KB
    on disk, under the automatic broadcast threshold, and is shuffled
    instead if it ever outgrows it.
    """
    distinct = seen_types.select("event_type").where(
        f"event_type IS NOT NULL AND event_type <> '{exclude}'").distinct()
    new = _with_now(distinct.join(table.select("event_type"), "event_type", "left_anti"), now).selectExpr(
        "event_type",
        "'Unknown' AS event_category",
        "event_type AS event_label",
        "CAST(NULL AS STRING) AS event_description",
        "false AS is_core_metric",
        "false AS is_curated",
        "__now AS discovered_at",
        f"'{INSERT}' AS {ACTION}",
    )
    return table.selectExpr("*", f"'{KEEP}' AS {ACTION}").unionByName(new)


def seed_upsert(table: DataFrame, seed: DataFrame, now: Column | str) -> DataFrame:
    """UPS-4: apply curated seed rows to the event-type dimension.

    On conflict the seed's category, label and core flag win and the row
    becomes curated; description and discovered_at are kept. Unknown seed
    rows are inserted as curated with ``discovered_at = now``.
    """
    cols = ["event_type", "event_category", "event_label", "event_description",
            "is_core_metric", "is_curated", "discovered_at"]
    t = table.selectExpr(*[f"`{c}` AS t_{c}" for c in cols])
    s = seed.selectExpr(*[f"`{c}` AS s_{c}" for c in cols])
    j = _with_now(t.join(s, F.expr("t_event_type = s_event_type"), "full_outer"), now)
    seeded, present = "s_event_type IS NOT NULL", "t_event_type IS NOT NULL"
    return j.selectExpr(
        "coalesce(t_event_type, s_event_type) AS event_type",
        f"CASE WHEN {seeded} THEN s_event_category ELSE t_event_category END AS event_category",
        f"CASE WHEN {seeded} THEN s_event_label ELSE t_event_label END AS event_label",
        f"CASE WHEN {present} THEN t_event_description ELSE s_event_description END AS event_description",
        f"CASE WHEN {seeded} THEN s_is_core_metric ELSE t_is_core_metric END AS is_core_metric",
        f"CASE WHEN {seeded} THEN true ELSE t_is_curated END AS is_curated",
        f"CASE WHEN {present} THEN t_discovered_at ELSE __now END AS discovered_at",
        f"CASE WHEN NOT {present} THEN '{INSERT}' WHEN {seeded} THEN '{UPDATE}' ELSE '{KEEP}' END AS {ACTION}",
    )

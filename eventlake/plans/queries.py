"""Analytics (Q-1..Q-6) and health checks (H-1..H-6) over published gold.

Each query is a function of DataFrames and explicit ``as_of`` values (never
the wall clock), so it is reproducible and testable. Those that only count
(Q-1, Q-3, Q-5, H-1, H-3, H-4) take the facts or the aggregates that gold runs
keep of them (``plans/rollups.py``: ``Warehouse.hours`` and ``distinct_ids``),
with the same answer; the registered queries take the aggregates and read no
facts. Scale notes:

* dim_date has a fixed size (6,940 rows), so broadcasting it is safe; the
  date window is also applied to the fact table's ``date_id`` partition
  column directly, which prunes fact partitions at planning time.
* facts are pre-aggregated to (key, ...) counts before any join with a
  dimension, so a hot key costs one row per map task in the shuffle and a
  dimension meets one row per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.plans import rollups as R


#: Tasks over which the actors of one of the top repos are dealt.
SLICES = 16


def _counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Events by ``keys`` as ``n``, of facts or of ``hours`` aggregates."""
    kept = "events" in rows.columns
    return rows.groupBy(*keys).agg((F.sum("events") if kept else F.count(F.lit(1))).alias("n"))


def _date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def _key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def daily_volume(rows: DataFrame, dim_date: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Q-1: events, distinct actors and repos per day since ``as_of - days``.

    Distinct ids are bits: one row per (day, bucket of ids) is shuffled, built
    in the map tasks, instead of every distinct pair. ``rows`` are facts or
    ``distinct_ids`` aggregates.
    """
    start = _date(as_of) - dt.timedelta(days=days)
    f = rows.filter(F.col("date_id") >= _key(start))
    bits = R.merged_ids(f) if "bits" in rows.columns else R.ids(f.select("date_id", "actor_id", "repo_id"))
    of = lambda what, value: F.sum(F.when(F.col("what") == what, value)).cast("bigint")
    per_date = bits.groupBy("date_id").agg(
        of("actor", F.col("events")).alias("total_events"),  # an event has one actor
        of("actor", F.bitmap_count("bits")).alias("unique_users"), of("repo", F.bitmap_count("bits")).alias("unique_repos"))
    d = F.broadcast(dim_date.filter(F.col("full_date") >= F.lit(start)).select("date_id", "full_date"))
    return per_date.join(d, "date_id").select("full_date", "total_events", "unique_users", "unique_repos").orderBy("full_date")


def top_repos(facts: DataFrame, dim_repos: DataFrame, dim_date: DataFrame, as_of,
              k: int = 10) -> DataFrame:
    """Q-2: top ``k`` (repo_name, repo_owner) by events in ``as_of``'s month.

    Grouping is by name and owner, not id: repos sharing a name merge. Ties
    on the count are broken by name and owner so the top-k is deterministic.

    Events are counted per repo first, so the dimension meets one row per repo
    however hot it is. That pass finds the hot repos: contributors are counted
    for the ``k`` names only, and where the planner cannot broadcast their repos
    the join deals each over slices of its actors, so that their dimension rows,
    and no others, are repeated.
    """
    d0 = _date(as_of)
    month = F.broadcast(dim_date.filter((F.col("year") == d0.year) & (F.col("month") == d0.month))
                        .select("date_id"))
    lo, hi = _key(d0.replace(day=1)), _key(d0.replace(day=28)) + 3
    f = facts.filter(F.col("date_id").between(lo, hi)).join(month, "date_id")
    repos = dim_repos.select("repo_id", "repo_name", "repo_owner")
    top = (f.groupBy("repo_id").agg(F.count(F.lit(1)).alias("n")).join(repos, "repo_id")
           .groupBy("repo_name", "repo_owner").agg(F.sum("n").alias("total_events"))
           .orderBy(F.desc("total_events"), "repo_name", "repo_owner").limit(k))
    # k rows; a repo without an owner is found by a null-safe comparison.
    found = F.broadcast(top.withColumnsRenamed({"repo_name": "name", "repo_owner": "owner"}))
    slices = F.explode(F.array(*(F.lit(i).cast("long") for i in range(SLICES)))).alias("slice")
    of_top = repos.join(found, F.col("repo_name").eqNullSafe(F.col("name")) & F.col("repo_owner").eqNullSafe(F.col("owner")))
    group = ["repo_name", "repo_owner", "total_events"]
    sliced = f.select("repo_id", "actor_id", F.pmod(F.xxhash64("actor_id"), F.lit(SLICES)).alias("slice"))
    people = sliced.join(of_top.select("*", slices), ["repo_id", "slice"]).groupBy(*group, "actor_id").agg(F.count(F.lit(1)).alias("n"))
    return (people.groupBy(*group).agg(F.count(F.lit(1)).alias("contributors"))
            .orderBy(F.desc("total_events"), "repo_name", "repo_owner"))


def hourly_weekend(rows: DataFrame, dim_date: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Q-3: events by hour of day and weekend flag since ``as_of - days``."""
    start = _date(as_of) - dt.timedelta(days=days)
    d = F.broadcast(dim_date.filter(F.col("full_date") >= F.lit(start)).select("date_id", "is_weekend"))
    per_hour = _counts(rows.filter(F.col("date_id") >= _key(start)), "date_id", "event_hour")
    return (per_hour.join(d, "date_id")
            .groupBy("event_hour", "is_weekend").agg(F.sum("n").alias("events"))
            .orderBy("is_weekend", "event_hour"))


def pending_types(dim_event_types: DataFrame) -> DataFrame:
    """Q-4: auto-discovered types waiting for curation, newest first."""
    return (dim_event_types.filter(~F.col("is_curated"))
            .select("event_type", "discovered_at").orderBy(F.desc("discovered_at")))


def top_actors(facts: DataFrame, dim_actors: DataFrame, k: int = 10) -> DataFrame:
    """JOIN-5: top ``k`` actors by events, with login and repos touched. Ties
    go to the smaller id."""
    per_pair = facts.groupBy("actor_id", "repo_id").agg(F.count(F.lit(1)).alias("n"))
    top = (per_pair.groupBy("actor_id").agg(F.sum("n").alias("total_events"), F.count(F.lit(1)).alias("repos"))
           .orderBy(F.desc("total_events"), "actor_id").limit(k))
    return top.join(dim_actors.select("actor_id", "actor_login"), "actor_id")


def events_by_calendar(rows: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Events per quarter, month, ISO week and day of the week (FN-6, FN-8)."""
    per_date = _counts(rows, "date_id")
    return (per_date.join(F.broadcast(dim_date), "date_id")
            .groupBy("year", "quarter", "month_name", "week", "day_of_week", "day_name", "is_weekend")
            .agg(F.sum("n").alias("events")))


def events_by_category(rows: DataFrame, dim_event_types: DataFrame) -> DataFrame:
    """Q-5: events per category and core-metric flag."""
    per_type = _counts(rows, "event_type")
    # Left to the planner: a few KB on disk, broadcast under its threshold.
    types = dim_event_types.select("event_type", "event_category", "is_core_metric")
    return (per_type.join(types, "event_type")
            .groupBy("event_category", "is_core_metric").agg(F.sum("n").alias("events")))


def last_24h(facts: DataFrame, as_of_ts, hours: int = 24) -> DataFrame:
    """Q-6: events per type with ``event_time >= as_of_ts - hours``."""
    ts = as_of_ts if isinstance(as_of_ts, dt.datetime) else dt.datetime.fromisoformat(str(as_of_ts))
    start = ts - dt.timedelta(hours=hours)
    return (facts.filter(F.col("date_id") >= _key(start.date()))
            .filter(F.col("event_time") >= F.to_timestamp(F.lit(start.strftime("%Y-%m-%d %H:%M:%S"))))
            .groupBy("event_type").agg(F.count(F.lit(1)).alias("events")))


def gold_freshness(rows: DataFrame) -> DataFrame:
    """H-1: the newest silver processing time that reached gold."""
    return rows.agg(F.max("newest" if "newest" in rows.columns else "silver_processed_at").alias("freshness"))


def sentinel_counts(rows: DataFrame) -> DataFrame:
    """H-3 / H-4: facts routed to the unknown actor / unknown repo."""
    if "unknown_actors" in rows.columns:
        return rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("unknown_actors", "unknown_repos")))
    return rows.agg(
        F.count_if(F.col("actor_id") == S.UNKNOWN_ACTOR_ID).cast("bigint").alias("unknown_actors"),
        F.count_if(F.col("repo_id") == S.UNKNOWN_REPO_ID).cast("bigint").alias("unknown_repos"))

"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

All of them read the driver's ``events`` table through the fixture, and most
of them read the warehouse that Spark builds from it by replaying the four
arrival batches through bronze, silver and gold (built once under the
shared scratch folder and reused while the input and the code are unchanged).
Timestamps are rendered as ``yyyy-MM-dd HH:mm:ss`` text and run-dependent
stamps (updated_at, discovered_at, durations) are left out, so results are
comparable with the SQL oracles.
"""

from __future__ import annotations

import uuid

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.functions.rules import ts_text
from eventlake.operators import validate as V
from eventlake.operators.classify import classify
from eventlake.operators.conform import conform
from eventlake.operators.dedupe import latest_by_key
from eventlake.operators.extract import extract
from eventlake.operators.merge import ACTION, insert_new_types, seed_upsert
from eventlake.plans import queries as Q
from eventlake.plans.bronze import backlog
from eventlake.plans.replay import replayed
from eventlake.plans.warehouse import lit_ts
from eventlake.session import configure, scratch_root
from eventlake.sources import fixture as FX
from eventlake.sources import seeds
from eventlake.sources.landing import read_json_arrays

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str):
    configure(spark)
    return replayed(spark, sf_dir)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return FX.envelope(FX.fixture(FX.read_events(spark, sf_dir)))


def _bronze_view(bronze: DataFrame) -> DataFrame:
    v = F.col("full_json")
    return bronze.select(
        "event_id", "event_type", "batch_id",
        F.try_variant_get(v, "$.actor.login", "string").alias("actor_login"),
        F.try_variant_get(v, "$.created_at", "string").alias("created_at"))


def bronze_dedupe_first(spark, sf_dir):
    """DED-1 / SNK-1: bronze after four batches; first arrival of an id wins."""
    return _bronze_view(_wh(spark, sf_dir).bronze_events())


def bronze_stream_dedupe(spark, sf_dir):
    """STR-1: the same bronze, ingested by the file stream (availableNow)."""
    configure(spark)
    return _bronze_view(replayed(spark, sf_dir, "stream").bronze_events())


def bronze_rejects(spark, sf_dir):
    """REJ-1: dead-letter reasons of damaged lines.

    Counted with one conditional aggregate per reason and filtered after
    it: a filter on ``reject_reason`` itself would be pushed below the
    staged parse and inline it whole.
    """
    c = classify(FX.corrupt(_lines(spark, sf_dir)))
    reasons = [S.REJECT_NOT_JSON, S.REJECT_NOT_OBJECT, S.REJECT_MISSING_ID,
               S.REJECT_INVALID_ID, S.REJECT_NUL]
    counts = c.agg(*[F.count_if(F.col("reject_reason") == r).alias(r) for r in reasons])
    long = counts.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("reason"), F.col(r).cast("bigint").alias("n_rows")) for r in reasons
    ])).alias("x")).select("x.*")
    return long.filter(F.col("n_rows") > 0)


def silver_extract(spark, sf_dir):
    """PRJ-2: typed silver columns extracted from the stored JSON."""
    s = _wh(spark, sf_dir).silver_events()
    return s.select(
        "event_id", "event_type", "actor_id", "actor_login", "repo_id", "repo_name",
        "org_id", "org_login", ts_text(F.col("event_time")).alias("event_time"), "is_public",
        ts_text(F.col("processed_at")).alias("processed_at"),
        F.try_variant_get("payload", "$.k", "bigint").alias("payload_k"))


def silver_backlog(spark, sf_dir):
    """JOIN-1 / H-2: bronze rows not yet in silver when silver stopped at run 1."""
    b = backlog(_wh(spark, sf_dir), silver_upto=1)
    return b.groupBy("batch_id").agg(F.count(F.lit(1)).alias("backlog"))


def _conformed(spark, sf_dir) -> DataFrame:
    return conform(_wh(spark, sf_dir).silver_events(), keep=("run_id",))


def conform_events(spark, sf_dir):
    """PRJ-3: the conformed view over silver."""
    v = _conformed(spark, sf_dir)
    return v.select(
        "event_id", ts_text(F.col("event_time")).alias("event_time"), "event_type",
        ts_text(F.col("processed_at")).alias("processed_at"), "date_id", "event_hour",
        "actor_id", "actor_login", "repo_id", "repo_name", "org_id", "org_login", "is_public")


def sentinel_counts(spark, sf_dir):
    """H-3 / H-4: facts on the unknown actor / repo."""
    return Q.sentinel_counts(_wh(spark, sf_dir).hours())


def dim_actors_latest(spark, sf_dir):
    """DED-3: latest login per actor over all of silver in one pass."""
    v = _conformed(spark, sf_dir).filter(F.col("actor_id") != S.UNKNOWN_ACTOR_ID)
    return latest_by_key(v, ["actor_id"]).select(
        "actor_id", "actor_login", ts_text(F.col("event_time")).alias("last_event_time"))


def dim_actors_upserted(spark, sf_dir):
    """UPS-1: dim_actors after four incremental runs (late rows guarded)."""
    d = _wh(spark, sf_dir).dim("dim_actors")
    return d.select("actor_id", "actor_login", ts_text(F.col("last_event_time")).alias("last_event_time"))


def dim_repos_upserted(spark, sf_dir):
    """UPS-1 + FN-10..12: dim_repos after four incremental runs."""
    d = _wh(spark, sf_dir).dim("dim_repos")
    return d.select("repo_id", "repo_name", "repo_owner", "repo_project", "org_id", "org_login",
                    ts_text(F.col("last_event_time")).alias("last_event_time"))


_TYPE_COLUMNS = ["event_type", "event_category", "event_label", "event_description",
                 "is_core_metric", "is_curated"]


def event_type_discovery(spark, sf_dir):
    """UPS-2: seeded types plus auto-discovered ones."""
    return _wh(spark, sf_dir).dim("dim_event_types").select(*_TYPE_COLUMNS)


def event_type_seed_upsert(spark, sf_dir):
    """UPS-4: discovery into an empty dimension, then the curated seed."""
    now = lit_ts("2024-03-01 00:00:00")
    found = insert_new_types(seeds.empty(spark, S.DIM_EVENT_TYPES),
                             _conformed(spark, sf_dir).select("event_type"), now, S.UNKNOWN_EVENT_TYPE)
    return seed_upsert(found.drop(ACTION), seeds.event_type_seed(spark), now).select(*_TYPE_COLUMNS)


def fact_incremental(spark, sf_dir):
    """FLT-3 / AGG-5 / UPS-3 / PRJ-4: facts loaded run by run."""
    f = _wh(spark, sf_dir).facts()
    return f.select(
        "event_id", "date_id", "repo_id", "actor_id", "event_type", "event_hour",
        ts_text(F.col("event_time")).alias("event_time"), "is_public",
        ts_text(F.col("silver_processed_at")).alias("silver_processed_at"), "run_id")


def fact_fk_violations(spark, sf_dir):
    """VAL-1: facts of all runs against the dimensions published by run 1."""
    wh = _wh(spark, sf_dir)
    return V.fk_violations(wh.facts(), {
        "fk_date_id": (wh.dim_date(), "date_id"),
        "fk_actor_id": (wh.dim("dim_actors", 1), "actor_id"),
        "fk_repo_id": (wh.dim("dim_repos", 1), "repo_id"),
        "fk_event_type": (wh.dim("dim_event_types", 1), "event_type"),
    })


def fact_key_checks(spark, sf_dir):
    """VAL-2..4 on the extracted fixture rows before any dedupe.

    Accepted rows are selected inside the aggregates (``count_if``), not by
    a filter that Catalyst would push below the staged extraction.
    """
    x = extract(classify(_lines(spark, sf_dir))).withColumn(
        "event_hour", F.hour("event_time").cast("int"))
    checks = {**V.not_null(["event_time", "event_type", "actor_login"]),
              **V.hour_in_range(), **V.too_long(S.SILVER_LENGTH_LIMITS)}
    return V.key_and_row_checks(x, ["event_id"], "duplicate_event_id", checks,
                                where=F.col("reject_reason").isNull(), one_pass=True)


def daily_volume(spark, sf_dir):
    """Q-1."""
    wh = _wh(spark, sf_dir)
    return Q.daily_volume(wh.distinct_ids(), wh.dim_date(), FX.AS_OF_DATE)


def top_repos(spark, sf_dir):
    """Q-2."""
    wh = _wh(spark, sf_dir)
    return Q.top_repos(wh.facts(), wh.dim("dim_repos"), wh.dim_date(), FX.AS_OF_DATE)


def hourly_weekend(spark, sf_dir):
    """Q-3."""
    wh = _wh(spark, sf_dir)
    return Q.hourly_weekend(wh.hours(), wh.dim_date(), FX.AS_OF_DATE)


def pending_types(spark, sf_dir):
    """Q-4 with its order (newest first; discovered_at itself is a run stamp)."""
    pending = Q.pending_types(_wh(spark, sf_dir).dim("dim_event_types"))
    newest_first = Window.orderBy(F.desc("discovered_at"), "event_type")  # a row per type of the dimension
    return pending.select("event_type", F.row_number().over(newest_first).cast("long").alias("place"))


def top_actors(spark, sf_dir):
    """JOIN-5: facts with dim_actors."""
    wh = _wh(spark, sf_dir)
    return Q.top_actors(wh.facts(), wh.dim("dim_actors"))


def events_by_calendar(spark, sf_dir):
    """FN-6 / FN-8 / SRC-5: facts by quarter, month, ISO week and day name."""
    wh = _wh(spark, sf_dir)
    return Q.events_by_calendar(wh.hours(), wh.dim_date())


def _edges(spark, sf_dir):
    configure(spark)
    return replayed(spark, sf_dir, "edges")


def dead_letter_report(spark, sf_dir):
    """SNK-2: reasons and bytes of the stored dead letters of hostile lines."""
    return _edges(spark, sf_dir).dead_letters().groupBy("batch_id", F.col("error_message").alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("failed_payload")).alias("chars"))


def silver_rejects_report(spark, sf_dir):
    """FLT-1 / VAL-4: bronze rows that silver recorded as rejected."""
    return _edges(spark, sf_dir).silver_rejects().groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("ids"))


def edge_facts(spark, sf_dir):
    """One key per id spelling, long names on the sentinel repo, offsets and
    fractions of seconds: the facts of the hostile lines."""
    facts = _edges(spark, sf_dir).facts()
    time = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS")
    return facts.groupBy("repo_id", time.alias("event_time")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("event_id") == "True").alias("boolean_ids"))


def edge_run_report(spark, sf_dir):
    """H-5: facts and long names that each run of the hostile lines counted."""
    wh = _edges(spark, sf_dir)
    return wh.run_metrics().filter(F.col("run_id") >= 1).select("run_id", "facts_inserted", "total_facts", "long_names")


def json_array_ingest(spark, sf_dir):
    """SRC-2: events landed as JSON-array documents, a file each, and read back."""
    configure(spark)
    folder = f"{scratch_root(spark)}/eventlake-arrays/{uuid.uuid4().hex}"
    FX.json_array_documents(FX.read_events(spark, sf_dir)).write.partitionBy("doc").text(folder)
    lines = classify(read_json_arrays(spark, f"{folder}/doc=*"))
    return lines.select("event_id", "event_type", F.col("arrival_pos").alias("place"),
                        F.try_variant_get("full_json", "$.actor.id", "bigint").alias("actor_id"), "reject_reason")


def _kind(spark, sf_dir, kind: str):
    configure(spark)
    return replayed(spark, sf_dir, kind)


def etl_stream_runs(spark, sf_dir):
    """STR-2 / PUB-2: silver and gold run by the stream over bronze's commits."""
    m = _kind(spark, sf_dir, "etl").run_metrics().filter(F.col("run_id") >= 1)
    return m.select("run_id", "types_inserted", "facts_inserted", "total_facts", ts_text(F.col("watermark_after")).alias("watermark"))


def stream_retry_report(spark, sf_dir):
    """STR-4: bronze batches of a stream whose writer was lost after every
    commit, each micro-batch so being replayed once."""
    return _kind(spark, sf_dir, "retried").bronze_reports().select("batch_id", "fetched", "inserted", "duplicates", "errors")


def rebuilt_facts(spark, sf_dir):
    """SNK-5: facts of a warehouse whose silver and gold were dropped and made
    anew from bronze in one run."""
    f = _kind(spark, sf_dir, "rebuilt").facts()
    return f.groupBy("run_id", "date_id", "event_type").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("actor_id").alias("actors"))


def seeded_dimensions(spark, sf_dir):
    """UPS-5: rows and sentinels of the dimensions after the seeds were applied
    to the live warehouse, twice."""
    wh = _kind(spark, sf_dir, "rebuilt")
    of = lambda name, sentinel: wh.dim(name).agg(
        F.lit(name).alias("dimension"), F.count(F.lit(1)).alias("n_rows"), F.count_if(sentinel).alias("sentinels"))
    return (of("dim_actors", F.col("actor_id") == S.UNKNOWN_ACTOR_ID).unionByName(of("dim_repos", F.col("repo_id") == S.UNKNOWN_REPO_ID))
            .unionByName(of("dim_event_types", F.col("event_type") == S.UNKNOWN_EVENT_TYPE)))


def gold_step_times(spark, sf_dir):
    """FN-19: every gold run reports elapsed times, none of a step above the whole."""
    m = _wh(spark, sf_dir).run_metrics().filter(F.col("run_id") >= 1)
    steps = [F.col(f"ms_{s}") for s in ("actors", "repos", "types", "facts", "validate")]
    return m.select("run_id", "facts_inserted", (F.col("ms_total") > 0).alias("timed"),
                    (F.least(*steps) >= 0).alias("none_negative"), (F.greatest(*steps) <= F.col("ms_total")).alias("within_total"))


def fact_lookups(spark, sf_dir):
    """Facts of one repo and of one actor, from the merged, clustered facts."""
    facts = _kind(spark, sf_dir, "rebuilt").facts()
    of = lambda what, key: facts.where(F.col(key) == FX.LOOKED_UP[what]).groupBy("event_type").agg(
        F.lit(what).alias("what"), F.count(F.lit(1)).alias("events"), F.countDistinct("date_id").alias("days"))
    return of("repo", "repo_id").unionByName(of("actor", "actor_id"))


def events_by_category(spark, sf_dir):
    """Q-5."""
    wh = _wh(spark, sf_dir)
    return Q.events_by_category(wh.hours(), wh.dim("dim_event_types"))


def last_24h(spark, sf_dir):
    """Q-6."""
    return Q.last_24h(_wh(spark, sf_dir).facts(), FX.AS_OF_TS)


def gold_freshness(spark, sf_dir):
    """H-1."""
    return Q.gold_freshness(_wh(spark, sf_dir).hours()).select(ts_text(F.col("freshness")).alias("freshness"))


def gold_run_report(spark, sf_dir):
    """H-5: per-run counts and watermark (durations left out)."""
    m = _wh(spark, sf_dir).run_metrics().filter(F.col("run_id") >= 1)
    return m.select(
        "run_id", "actors_affected", "repos_affected", "types_inserted", "facts_inserted",
        "total_actors", "total_repos", "total_types", "total_facts",
        ts_text(F.col("watermark_after")).alias("watermark"))


def bronze_batch_report(spark, sf_dir):
    """H-6."""
    return _wh(spark, sf_dir).bronze_reports().select(
        "batch_id", "fetched", "inserted", "duplicates", "errors")


QUERIES: dict[str, Query] = {
    "bronze_dedupe_first": bronze_dedupe_first,
    "bronze_stream_dedupe": bronze_stream_dedupe,
    "bronze_rejects": bronze_rejects,
    "silver_extract": silver_extract,
    "silver_backlog": silver_backlog,
    "conform_events": conform_events,
    "sentinel_counts": sentinel_counts,
    "dim_actors_latest": dim_actors_latest,
    "dim_actors_upserted": dim_actors_upserted,
    "dim_repos_upserted": dim_repos_upserted,
    "event_type_discovery": event_type_discovery,
    "event_type_seed_upsert": event_type_seed_upsert,
    "fact_incremental": fact_incremental,
    "fact_fk_violations": fact_fk_violations,
    "fact_key_checks": fact_key_checks,
    "daily_volume": daily_volume,
    "top_repos": top_repos,
    "hourly_weekend": hourly_weekend,
    "pending_types": pending_types,
    "top_actors": top_actors,
    "events_by_calendar": events_by_calendar,
    "dead_letter_report": dead_letter_report,
    "silver_rejects_report": silver_rejects_report,
    "edge_facts": edge_facts,
    "edge_run_report": edge_run_report,
    "json_array_ingest": json_array_ingest,
    "etl_stream_runs": etl_stream_runs,
    "stream_retry_report": stream_retry_report,
    "rebuilt_facts": rebuilt_facts,
    "seeded_dimensions": seeded_dimensions,
    "gold_step_times": gold_step_times,
    "fact_lookups": fact_lookups,
    "events_by_category": events_by_category,
    "last_24h": last_24h,
    "gold_freshness": gold_freshness,
    "gold_run_report": gold_run_report,
    "bronze_batch_report": bronze_batch_report,
}

"""Aggregates kept per run, bitmaps, Q-2, growing buckets, the calendar and the
commit-driven ETL stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventlake.operators.validate import ValidationError
from eventlake.plans import queries as Q
from eventlake.plans import rollups as R
from eventlake.plans.bronze import backlog, ingest_batch
from eventlake.plans.gold import bootstrap, bucket_of, extend_calendar, run_gold, split_from
from eventlake.plans.pipeline import compact, merge_tiers, run_pipeline, vacuum
from eventlake.plans.silver import run_silver
from eventlake.plans.warehouse import Warehouse
from eventlake.streaming.etl_stream import EtlStream

from tests.test_pipeline import at, cycle, ev, lines
from tests.test_plans import plan


@pytest.fixture()
def wh(spark, root):
    w = Warehouse(spark, root)
    bootstrap(w)
    return w


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def answers(wh, kept):
    """Q-1, Q-3, Q-5, H-1, H-3, H-4 and the calendar query, of the aggregates or of the facts."""
    hours, ids = (wh.hours(), wh.distinct_ids()) if kept else (wh.facts(), wh.facts())
    d = wh.dim_date()
    return [rows(x) for x in (
        Q.daily_volume(ids, d, "2024-01-31", days=60), Q.hourly_weekend(hours, d, "2024-01-31", days=60),
        Q.events_by_category(hours, wh.dim("dim_event_types")), Q.gold_freshness(hours), Q.sentinel_counts(hours),
        Q.events_by_calendar(hours, d))]


def events(n, late=0):
    return [ev(f"{n}-{i}", actor=[None, -1, 5, 2**40, i % 4][i % 5], login=f"u{i}", repo=[7, 7, 8, "x", 40_000 + i][i % 5],
               t=f"2024-01-{max(1, 28 - late - i % 3):02d}T{i % 24:02d}:10:00Z", typ=["PushEvent", "NewEvent", None][i % 3]) for i in range(30)]


def test_aggregates_answer_as_the_facts_do(spark, wh):
    assert answers(wh, True) == answers(wh, False)                   # no facts yet
    for n, late in ((1, 0), (2, 20), (3, 1)):                          # the second batch is late
        cycle(wh, spark, events(n, late), n)
        assert answers(wh, True) == answers(wh, False)
    total = sum(e["rows"] for e in wh.gold_state()["rollups"])
    assert total == wh.facts().count() == 90
    before = answers(wh, True)
    merge_tiers(wh, fanout=2)
    assert len(wh.gold_state()["rollups"]) == 1 and answers(wh, True) == before
    cycle(wh, spark, events(4, 2), 4)
    before = answers(wh, False)
    assert len(wh.gold_state()["rollups"]) == 2 and answers(wh, True) == before
    compact(wh)
    assert len(wh.gold_state()["rollups"]) == 1 and answers(wh, True) == before
    # merged folders hold one row per group
    assert wh.hours().count() == wh.facts().select("date_id", "event_hour", "event_type").distinct().count()


def test_a_retried_run_is_counted_once(spark, wh):
    cycle(wh, spark, events(1), 1)
    ingest_batch(wh, lines(spark, events(2)), now=at(2))
    run_silver(wh, at(3))

    def boom(step):
        if step == "validate":
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        run_gold(wh, at(4), on_step=boom)
    assert answers(wh, True) == answers(wh, False) and wh.hours().agg(F.sum("events")).first()[0] == 30
    run_gold(wh, at(5))
    assert answers(wh, True) == answers(wh, False) and wh.hours().agg(F.sum("events")).first()[0] == 60


def test_records_without_aggregates(spark, wh):
    cycle(wh, spark, events(1), 1)
    state = wh.gold_state()
    wh.gold_log.commit(state, {k: v for k, v in state.items() if k not in ("rollups", "calendar")})
    assert answers(wh, True) == answers(wh, False)                    # taken from the facts
    cycle(wh, spark, events(2), 2)
    assert [e["id"] for e in wh.gold_state()["rollups"]] == [1, 2]
    assert answers(wh, True) == answers(wh, False)


def test_registered_counts_read_no_facts(spark, wh):
    cycle(wh, spark, events(1), 1)
    d = wh.dim_date()
    for df in (Q.daily_volume(wh.distinct_ids(), d, "2024-01-31"), Q.hourly_weekend(wh.hours(), d, "2024-01-31"),
               Q.events_by_category(wh.hours(), wh.dim("dim_event_types")), Q.sentinel_counts(wh.hours()), Q.gold_freshness(wh.hours())):
        assert not any("fact_events" in f for f in df.inputFiles())
        assert any("rollups" in f for f in df.inputFiles())
    assert "PartitionFilters: [isnotnull(kind" in plan(Q.sentinel_counts(wh.hours()))
    assert "Expand" not in plan(Q.daily_volume(wh.facts(), d, "2024-01-31"))


def test_bitmaps_tell_any_ids_apart(spark):
    ids = [0, 1, -1, 32767, 32768, -32767, -32768, 32769, 2**40, -(2**40), 2**62, -(2**62), 7, 7]
    facts = spark.createDataFrame([(20240101 + i % 2, x, x) for i, x in enumerate(ids * 3)], "date_id int, actor_id long, repo_id long")
    bits = R.merged_ids(R.ids(facts).unionByName(R.ids(facts)))
    got = {(r["date_id"], r["what"]): r["n"] for r in bits.groupBy("date_id", "what").agg(F.sum(F.bitmap_count("bits")).alias("n")).collect()}
    want = {(r["date_id"], w): r[w] for r in facts.groupBy("date_id").agg(
        F.countDistinct("actor_id").alias("actor"), F.countDistinct("repo_id").alias("repo")).collect() for w in ("actor", "repo")}
    assert got == want


def test_top_repos_meets_the_dimension_with_a_row_per_repo(spark, wh):
    """Shared names merge, a null owner is a group, and no dimension row is
    repeated but those of the names found."""
    facts = spark.createDataFrame(
        [(20240110, r, a) for r, n in ((1, 40), (2, 30), (3, 20), (4, 9), (5, 8)) for a in range(n)], "date_id int, repo_id long, actor_id long")
    dim = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "a", "x"), (4, "c", "y"), (5, "b", None), (6, "z", "z")],
                                "repo_id long, repo_name string, repo_owner string")
    got = [tuple(r) for r in Q.top_repos(facts, dim, wh.dim_date(), "2024-01-31", k=2).collect()]
    assert got == [("a", "x", 60, 40), ("b", None, 38, 30)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [tuple(r) for r in Q.top_repos(facts, dim, wh.dim_date(), "2024-01-31", k=2).collect()] == got
        tree = plan(Q.top_repos(facts, dim, wh.dim_date(), "2024-01-31", k=2))
        tree = tree[: tree.index("\n(1) ")]
        # dimension rows are repeated (Generate) once, above their join with the names found
        (above, below) = tree.split("Generate")
        assert "BroadcastExchange" in below and "TakeOrderedAndProject" in below
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_linear_hashing_moves_only_the_split_buckets(spark):
    keys = spark.range(5000).select(F.col("id").alias("k"))
    for n, more in ((1, 2), (5, 6), (8, 9), (8, 12), (8, 16), (8, 50), (13, 29)):
        sources = split_from(n, more)
        both = keys.select(bucket_of("k", n).alias("a"), bucket_of("k", more).alias("b")).collect()
        assert {r["b"] for r in both} <= set(range(more))
        assert {r["a"] for r in both if r["a"] != r["b"]} <= sources <= set(range(n))
        assert all(r["b"] >= n for r in both if r["a"] != r["b"])
        assert len(sources) <= more - n


def people(spark, first, n, t="2024-01-05T10:00:00Z", prefix=""):
    """Lines of n events, each of another actor."""
    text = json.loads(ev(0, t=t))
    return spark.range(first, first + n).select(
        F.concat(F.lit('{"id":"' + prefix), "id", F.lit('","type":"PushEvent","actor":{"id":'), F.col("id"), F.lit(',"login":"u"},"repo":{"id":1,"name":"a/b"},"created_at":"'),
                 F.lit(text["created_at"]), F.lit('"}')).alias("value"), F.lit("f").alias("arrival_file"), F.col("id").alias("arrival_pos"))


def test_bucket_count_follows_rows_and_small_batches_rewrite_little(spark, root):
    wh = Warehouse(spark, root)
    bootstrap(wh, dim_bucket_rows=160)
    ingest_batch(wh, people(spark, 1, 100_000), now=at(1))
    run_pipeline(wh, at(2))
    first = wh.gold_state()
    assert len(first["dims"]["dim_actors"]) == 625
    assert first["buckets"]["dim_actors"] == 625 and first["buckets"]["dim_repos"] == 8
    ingest_batch(wh, people(spark, 99_981, 50, "2024-01-06T10:00:00Z", "second-"), now=at(3))
    run_pipeline(wh, at(4))
    second = wh.gold_state()
    assert second["buckets"]["dim_actors"] == 626      # one more bucket for the sentinel's row
    before = {(e["id"], e["path"]) for e in first["dims"]["dim_actors"]}
    rewritten = sum(e["rows"] for e in second["dims"]["dim_actors"] if (e["id"], e["path"]) not in before)
    total = sum(e["rows"] for e in second["dims"]["dim_actors"])
    assert total == 100_031 == wh.dim("dim_actors").count() == wh.dim("dim_actors").select("actor_id").distinct().count()
    assert rewritten < 0.1 * total
    assert wh.dim("dim_actors").where("last_event_time = '2024-01-06 10:00:00'").count() == 50
    # every row lies in the bucket of its key, and older runs read theirs
    for n, run in ((626, 2), (625, 1)):
        wrong = wh.dim("dim_actors", run).withColumn("at", F.regexp_extract(F.input_file_name(), "bucket=([0-9]+)", 1).cast("int"))
        assert wrong.where(F.col("at") != bucket_of("actor_id", n)).count() == 0
    assert wh.dim("dim_actors", 1).count() == 100_001


def test_buckets_grow_with_every_run(spark, root):
    wh = Warehouse(spark, root)
    bootstrap(wh, dim_buckets=2, dim_bucket_rows=10)
    for n in range(1, 5):
        cycle(wh, spark, [ev(100 * n + i, actor=100 * n + i, repo=i, t=f"2024-01-0{n}T00:00:00Z") for i in range(25)], n)
        state = wh.gold_state()
        rows_ = sum(e["rows"] for e in state["dims"]["dim_actors"])
        assert rows_ == 25 * n + 1 == wh.dim("dim_actors").select("actor_id").distinct().count()
        assert state["buckets"]["dim_actors"] >= 2.5 * (n - 1) and state["buckets"]["dim_repos"] <= 3
    vacuum(wh, keep_runs=1)
    assert wh.dim("dim_actors").count() == 101 and wh.dim("dim_repos").count() == 25


def test_calendar_is_set_checked_and_extended(spark, root):
    wh = Warehouse(spark, root)
    bootstrap(wh, calendar=(dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
    assert wh.dim_date().count() == 31 and wh.calendar() == (20240101, 20240131)
    cycle(wh, spark, [ev(1)], 1)
    ingest_batch(wh, lines(spark, [ev(2, t="2029-03-01T00:00:00Z"), ev(3)]), now=at(2))
    run_silver(wh, at(3))
    for _ in range(2):
        with pytest.raises(ValidationError) as err:
            run_gold(wh, at(4))
        assert err.value.failures == {"fk_date_id": 1}
    with pytest.raises(ValueError, match="only be extended"):
        extend_calendar(wh, dt.date(2024, 1, 2), dt.date(2030, 1, 1), at(5))
    run = extend_calendar(wh, dt.date(2023, 12, 1), dt.date(2029, 12, 31), at(5))
    assert wh.published_run() == run and wh.dim_date().agg(F.max("date_id")).first()[0] == 20291231
    assert run_gold(wh, at(6))["facts_inserted"] == 2 and wh.facts().count() == 3
    assert answers(wh, True) == answers(wh, False)


def test_etl_waits_for_the_commit(spark, wh, monkeypatch):
    """A trigger between a batch's write and its commit leaves nothing behind."""
    ticks = iter(dt.datetime(2024, 2, 1, h, tzinfo=dt.timezone.utc) for h in range(1, 24))
    etl = EtlStream(wh, clock=lambda: next(ticks))
    ingest_batch(wh, lines(spark, [ev(1)]), now=at(1))
    assert len(etl.run_available()) == 1 and backlog(wh).count() == 0
    real, seen = wh.bronze_log.commit, []

    def held_back(state, record):
        # the data files are there, the record is not
        assert wh.fs.exists(record["raw_events"][-1]["path"])
        seen.append(etl.run_available())
        real(state, record)

    monkeypatch.setattr(wh.bronze_log, "commit", held_back)
    ingest_batch(wh, lines(spark, [ev(2), ev(3)]), now=at(2))
    assert seen == [[]] and backlog(wh).count() == 2
    runs = etl.run_available()
    assert len(runs) == 1 and runs[0]["gold"]["facts_inserted"] == 2
    assert backlog(wh).count() == 0 and wh.facts().count() == 3
    assert etl.run_available() == []

"""Plain SQL over the registered views agrees with the query functions."""

import datetime as dt

import pytest

from eventlake.plans import queries as Q
from eventlake.plans.bronze import ingest_batch
from eventlake.plans.gold import bootstrap, run_gold
from eventlake.plans.silver import run_silver
from eventlake.plans.warehouse import Warehouse

from tests.test_pipeline import at, ev, lines

AS_OF = "2024-01-31"


@pytest.fixture()
def views(spark, root):
    wh = Warehouse(spark, root)
    bootstrap(wh)
    events = [ev(i, actor=i % 4, login=f"l{i % 4}", repo=10 + i % 3, name=f"own{i % 2}/p{i % 3}",
                 t=f"2024-01-{i % 30 + 1:02d}T{i % 24:02d}:00:00Z",
                 typ="PushEvent" if i % 5 else "SponsorEvent") for i in range(1, 60)]
    ingest_batch(wh, lines(spark, events), batch_id=1, now=at(1))
    run_silver(wh, at(2))
    run_gold(wh, at(3))
    wh.register_views()
    return wh


def same(spark, sql, want):
    assert sorted(tuple(r) for r in spark.sql(sql).collect()) == sorted(tuple(r) for r in want.collect())


def test_volume_of_the_last_week(spark, views):
    same(spark, """
        WITH dated AS (SELECT to_date(event_time) AS day, * FROM fact_events)
        SELECT day, count(1), count(DISTINCT actor_id), count(DISTINCT repo_id) FROM dated
        WHERE day BETWEEN date'2024-01-24' AND date'2028-12-31' GROUP BY day""",
         Q.daily_volume(views.facts(), views.dim_date(), AS_OF))


def test_busiest_repos_of_the_month(spark, views):
    same(spark, """
        WITH month AS (SELECT * FROM fact_events WHERE date_id DIV 100 = 202401)
        SELECT repo_name, repo_owner, count(1) AS n, count(DISTINCT actor_id)
        FROM month INNER JOIN dim_repos USING (repo_id)
        GROUP BY ALL ORDER BY n DESC, repo_name, repo_owner LIMIT 10""",
         Q.top_repos(views.facts(), views.dim("dim_repos"), views.dim_date(), AS_OF))


def test_hours_on_weekends_and_pending_types(spark, views):
    same(spark, """
        SELECT event_hour, weekday(event_time) >= 5 AS weekend, count(1) FROM fact_events
        WHERE event_time >= timestamp'2024-01-01' GROUP BY ALL""",
         Q.hourly_weekend(views.facts(), views.dim_date(), AS_OF))
    same(spark, "SELECT event_type, discovered_at FROM dim_event_types WHERE NOT is_curated",
         Q.pending_types(views.dim("dim_event_types")))
    assert [r["event_type"] for r in Q.pending_types(views.dim("dim_event_types")).collect()] == ["SponsorEvent"]


def test_actors_and_calendar(spark, views):
    same(spark, """
        SELECT actor_id, count(1), count(DISTINCT repo_id), max(actor_login)
        FROM fact_events INNER JOIN dim_actors USING (actor_id) GROUP BY actor_id""",
         Q.top_actors(views.facts(), views.dim("dim_actors")))
    per_day = Q.events_by_calendar(views.facts(), views.dim_date()).groupBy("day_name").sum("events")
    same(spark, "SELECT date_format(event_time, 'EEEE'), count(1) FROM fact_events GROUP BY ALL", per_day)


def test_health(spark, views):
    health = spark.sql("""
        SELECT (SELECT max(silver_processed_at) FROM fact_events) AS fresh,
               (SELECT count(1) FROM bronze_raw_events ANTI JOIN silver_events USING (event_id)) AS backlog,
               (SELECT count_if(actor_id < 0) FROM fact_events) AS unknown,
               (SELECT sum(facts_inserted) FROM run_metrics) AS loaded,
               (SELECT sum(inserted) FROM batch_reports) AS stored""").first()
    assert health["fresh"].replace(tzinfo=dt.timezone.utc) == at(2)
    # actor id 0 is a falsy JSON number -> the unknown actor (14 of the events)
    assert health["unknown"] == Q.sentinel_counts(views.facts()).first()["unknown_actors"] == 14
    assert (health["backlog"], health["loaded"], health["stored"]) == (0, views.facts().count(), 59)

"""SRC-1 / SRC-2 / SRC-5 and STR-1: landing files, JSON arrays, calendar, file stream."""

import datetime as dt
import json

from eventlake.plans.bronze import ingest_batch
from eventlake.plans.warehouse import Warehouse
from eventlake.sources.calendar import dim_date
from eventlake.sources.landing import land, read_json_arrays, read_lines
from eventlake.streaming.bronze_stream import BronzeStream


def test_dim_date(spark):
    d = dim_date(spark)
    assert d.count() == 6940
    r = d.filter("date_id = 20210101").first()
    assert (r["week"], r["day_of_week"], r["day_name"], r["month_name"], r["quarter"], r["is_weekend"]) == (
        53, 5, "Friday", "January", 1, False)
    assert d.filter("date_id = 20240106").first()["is_weekend"] is True


def test_json_array_source(spark, tmp_path):
    p = tmp_path / "doc.json"
    events = [{"id": str(i), "type": "PushEvent"} for i in range(3)]
    p.write_text(json.dumps(events, indent=2))
    (tmp_path / "bad.json").write_text('{"not": "an array"}')
    rows = read_json_arrays(spark, str(tmp_path / "*.json")).collect()
    ok = sorted((r["arrival_pos"], json.loads(r["value"])["id"]) for r in rows if "doc" in r["arrival_file"])
    assert ok == [(0, "0"), (1, "1"), (2, "2")]
    assert [r["value"] for r in rows if "bad" in r["arrival_file"]] == ['{"not": "an array"}']


def _envelopes(spark, ids, login):
    vals = [(json.dumps({"id": str(i), "type": "PushEvent", "actor": {"id": 1, "login": login}}), n)
            for n, i in enumerate(ids)]
    return spark.createDataFrame(vals, "value string, seq long")


def test_landing_order_and_stream_equals_batch(spark, tmp_path):
    root = str(tmp_path / "wh")
    wh = Warehouse(spark, root)
    landing = wh.path("landing")
    land(spark, _envelopes(spark, [1, 2, 1], "a"), landing, "b00000001")
    stream = BronzeStream(wh, landing)
    reports = stream.run_available(now=dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    assert [(r["batch_id"], r["inserted"], r["duplicates"]) for r in reports] == [(1, 2, 1)]
    land(spark, _envelopes(spark, [2, 3], "b"), landing, "b00000002")
    reports = stream.run_available()
    assert [(r["batch_id"], r["inserted"], r["duplicates"]) for r in reports] == [(2, 1, 1)]
    assert stream.run_available() == []          # nothing new: no micro-batch
    streamed = sorted((r["event_id"], r["batch_id"]) for r in wh.bronze_events().collect())

    wb = Warehouse(spark, str(tmp_path / "wb"))
    ingest_batch(wb, read_lines(spark, f"{landing}/b00000001-*.jsonl"), batch_id=1)
    ingest_batch(wb, read_lines(spark, f"{landing}/b00000002-*.jsonl"), batch_id=2)
    assert sorted((r["event_id"], r["batch_id"]) for r in wb.bronze_events().collect()) == streamed
    logins = {r["event_id"]: json.loads(str(r["full_json"]))["actor"]["login"]
              for r in wh.bronze_events().collect()}
    assert logins == {"1": "a", "2": "a", "3": "b"}


def test_continuous_trigger(spark, tmp_path):
    """STR-1 with a processing-time trigger: files landed while the query
    runs are ingested by later micro-batches."""
    import time

    wh = Warehouse(spark, str(tmp_path / "wh"))
    landing = wh.path("landing")
    land(spark, _envelopes(spark, [1, 2], "a"), landing, "b00000001")
    stream = BronzeStream(wh, landing)
    q = stream.start("1 second")
    try:
        deadline = time.time() + 120
        while len(stream.reports) < 1 and time.time() < deadline:
            time.sleep(0.5)
        land(spark, _envelopes(spark, [2, 3], "b"), landing, "b00000002")
        while sum(r["inserted"] for r in stream.reports) < 3 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        q.stop()
    assert q.exception() is None
    assert sorted(r["event_id"] for r in wh.bronze_events().collect()) == ["1", "2", "3"]


def test_etl_stream_runs_silver_and_gold_on_new_bronze(spark, tmp_path):
    from eventlake.plans.gold import bootstrap
    from eventlake.streaming.etl_stream import EtlStream

    wh = Warehouse(spark, str(tmp_path / "wh"))
    bootstrap(wh)
    ticks = iter(dt.datetime(2024, 2, 1, h, tzinfo=dt.timezone.utc) for h in range(1, 24))
    etl = EtlStream(wh, clock=lambda: next(ticks))
    assert etl.run_available() == []                     # no bronze yet, no run
    ingest_batch(wh, read_lines_df(spark, [1, 2]), batch_id=1)
    runs = etl.run_available()
    assert len(runs) == 1 and runs[0]["gold"]["facts_inserted"] == 2
    ingest_batch(wh, read_lines_df(spark, [2, 3]), batch_id=2)
    runs = etl.run_available()
    assert len(runs) == 1 and runs[0]["gold"]["facts_inserted"] == 1
    assert wh.facts().count() == 3


def read_lines_df(spark, ids):
    vals = [(json.dumps({"id": str(i), "type": "PushEvent", "actor": {"id": i, "login": "x"},
                         "repo": {"id": 5, "name": "a/b"}, "created_at": "2024-01-02T03:04:05Z"}), "f", n)
            for n, i in enumerate(ids)]
    return spark.createDataFrame(vals, "value string, arrival_file string, arrival_pos long")

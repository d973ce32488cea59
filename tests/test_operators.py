"""REJ-1, PRJ-2, PRJ-3, DED-1, DED-3, UPS-1..4 on hand-made rows (FIXTURES §4)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.operators.classify import classify
from eventlake.operators.conform import conform
from eventlake.operators.dedupe import first_arrival, latest_by_key
from eventlake.operators.extract import extract
from eventlake.operators.merge import (
    ACTION, insert_ignore, insert_new_types, seed_upsert, upsert_if_newer,
)
from eventlake.sources import seeds

UTC = dt.timezone.utc


def ev(i, **kw):
    n = i if isinstance(i, int) else 0
    e = {"id": str(i), "type": "PushEvent", "actor": {"id": 10 + n, "login": f"u{n}"},
         "repo": {"id": 500 + n, "name": f"o{n}/p{n}"}, "payload": {"n": n}, "public": True,
         "created_at": "2024-01-05T10:00:00Z"}
    e.update(kw)
    return json.dumps(e)


def _classify(spark, lines):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, pos long")
    return {r["pos"]: r["reject_reason"] for r in classify(df).collect()}


def test_reject_reasons(spark):
    lines = [ev(1), "not json", "", "[1,2]", '"x"', "3", '{"type":"A"}', '{"id":null}',
             '{"a":1} xx', ev(2, type="a\u0000b"), '{"id":{"x":1}}', '{"id":""}', '{"id":0}',
             '{"id":"1"}\t', '\r\n {"id":"1"}\n', ev(1) + ev(1), ev(1) + "," + ev(1), ev(1) + "] xx}",
             ev(1) + "} xx", ev(1) + "],[1", ev(1) + '},{"x":1', "{}", '{"id":"1"} // c', "nul", ev(1) + ", null"]
    got = _classify(spark, lines)
    assert got == {0: None, 1: "not_json", 2: "not_json", 3: "not_object", 4: "not_object",
                   5: "not_object", 6: "missing_id", 7: "missing_id", 8: "not_json",
                   9: "nul_character", 10: "invalid_id", 11: None, 12: None,
                   13: None, 14: None, **{n: "not_json" for n in range(15, 21)}, 21: "missing_id",
                   **{n: "not_json" for n in range(22, 25)}}


def test_one_key_for_every_spelling(spark):
    df = spark.createDataFrame([(v,) for v in ('{"id":true}', '{"id":"True"}', '{"id":1}', '{"id":"1"}', '{"id":1.5}', '{"id":[1]}')], "value string")
    assert [r["event_id"] for r in classify(df).collect()] == ["True", "True", "1", "1", "1.5", "[1]"]


def _extract(spark, lines):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    return extract(classify(df)).orderBy("value").collect()


def test_extract_rules(spark):
    rows = _extract(spark, [
        ev(1),                                                       # 1: no org
        ev(2, org={"id": 77, "login": "acme"}),                      # 2: org
        ev(3, actor={"id": 0, "login": ""}),                         # 9: number 0 -> NULL
        ev(4, actor={"id": "0", "login": "z"}),                      # 9: string "0" stays
        ev(5, actor="str", repo=None),                               # 10
        ev(6, type=""),                                              # 11
        ev(7, public="false", payload=None),                         # 16, 17
        ev(8, created_at="2026-13-01T00:00:00Z"),                    # 12
        ev(9, created_at=20240101),                                  # non-string time
    ])
    by_id = {r["event_id"]: r for r in rows}
    assert by_id["1"]["org_id"] is None and by_id["1"]["org_login"] is None
    assert (by_id["2"]["org_id"], by_id["2"]["org_login"]) == ("77", "acme")
    assert by_id["3"]["actor_id"] is None and by_id["3"]["actor_login"] is None
    assert by_id["4"]["actor_id"] == "0"
    assert by_id["5"]["actor_id"] is None and by_id["5"]["repo_id"] is None
    assert by_id["6"]["event_type"] is None
    assert by_id["7"]["is_public"] is False
    assert str(by_id["7"]["payload"]) == "null"
    assert str(by_id["1"]["payload"]) == '{"n":1}'
    assert by_id["8"]["event_time"] is None and by_id["9"]["event_time"] is None
    assert by_id["1"]["event_time"].replace(tzinfo=UTC) == dt.datetime(2024, 1, 5, 10, tzinfo=UTC)
    assert all(r["silver_reject_reason"] is None for r in rows)


def test_extract_public_and_payload_defaults(spark):
    d = json.loads(ev(1))
    del d["public"], d["payload"]
    explicit_null = json.loads(ev(2))
    explicit_null["public"] = None
    rows = {r["event_id"]: r for r in _extract(spark, [json.dumps(d), json.dumps(explicit_null)])}
    assert rows["1"]["is_public"] is True and str(rows["1"]["payload"]) == "{}"
    assert rows["2"]["is_public"] is None


def test_silver_rejects_falsy_and_long_ids(spark):
    rows = _extract(spark, ['{"id":""}', '{"id":0}', ev("x" * 51), ev(3, type="T" * 51)])
    long = _extract(spark, [ev(4, repo={"id": "n", "name": "r" * 300}, actor={"id": 1, "login": "l" * 300})])
    assert [r["silver_reject_reason"] for r in long] == [None] and len(long[0]["repo_name"]) == 300
    reasons = sorted(r["silver_reject_reason"] for r in rows)
    assert reasons == ["falsy_id", "falsy_id", "too_long:event_id", "too_long:event_type"]


def test_conform_defaults(spark):
    src = spark.createDataFrame([(v,) for v in [
        ev(1, actor={"id": "12a"}, repo={"id": 99999999999999999999}, type=None, public=None),
        ev(2, created_at="nope")]], "value string")
    x = extract(classify(src)).withColumn("processed_at", F.current_timestamp())
    out = conform(x).collect()
    assert len(out) == 1  # the row without a time is hidden
    r = out[0]
    assert (r["actor_id"], r["actor_login"], r["repo_id"], r["repo_name"]) == (
        -1, "unknownuser", -1, "unknownrepo")
    assert (r["event_type"], r["org_id"], r["org_login"], r["is_public"]) == (
        "UnknownEvent", None, "independent", True)
    assert (r["date_id"], r["event_hour"]) == (20240105, 10)


def test_first_arrival_and_latest_tie(spark):
    df = spark.createDataFrame(
        [("a", 2, "x2"), ("a", 1, "x1"), ("b", 5, "y")], "event_id string, pos int, v string")
    got = {r["event_id"]: r["v"] for r in first_arrival(df, "event_id", ["pos"]).collect()}
    assert got == {"a": "x1", "b": "y"}
    t = dt.datetime(2024, 1, 1, tzinfo=UTC)
    ties = spark.createDataFrame([(1, t, "9", "old"), (1, t, "10", "new"), (1, t, "8", "z")],
                                 "actor_id long, event_time timestamp, event_id string, login string")
    # string order: "9" > "8" > "10"
    assert latest_by_key(ties, ["actor_id"]).first()["login"] == "old"


def _dim(spark, rows):
    return spark.createDataFrame(rows, S.DIM_ACTORS)


def test_upsert_if_newer_guard(spark):
    t0 = dt.datetime(2024, 1, 1, tzinfo=UTC)
    t1 = dt.datetime(2024, 1, 2, tzinfo=UTC)
    dim = _dim(spark, [(1, "a", None, t1), (2, "b", None, t1), (3, "c", None, None)])
    upd = spark.createDataFrame(
        [(1, "a-old", t0), (2, "b-same", t1), (3, "c-new", t1), (4, "d", t0)],
        "actor_id long, actor_login string, last_event_time timestamp")
    now = F.lit(dt.datetime(2024, 2, 1, tzinfo=UTC)).cast("timestamp")
    got = {r["actor_id"]: (r["actor_login"], r[ACTION], r["updated_at"] is not None)
           for r in upsert_if_newer(dim, upd, "actor_id", now).collect()}
    assert got == {1: ("a", "keep", False), 2: ("b", "keep", False),
                   3: ("c", "keep", False), 4: ("d", "insert", True)}
    newer = spark.createDataFrame([(1, "a-new", dt.datetime(2024, 1, 3, tzinfo=UTC))],
                                  "actor_id long, actor_login string, last_event_time timestamp")
    r = {r["actor_id"]: r for r in upsert_if_newer(dim, newer, "actor_id", now).collect()}
    assert (r[1]["actor_login"], r[1][ACTION]) == ("a-new", "update")


def test_discovery_and_seed_upsert(spark):
    now = F.lit(dt.datetime(2024, 2, 1, tzinfo=UTC)).cast("timestamp")
    seen = spark.createDataFrame([("NewEvent",), ("NewEvent",), ("UnknownEvent",), ("PushEvent",), (None,)],
                                 "event_type string")
    base = seed_upsert(seeds.empty(spark, S.DIM_EVENT_TYPES), seeds.event_type_seed(spark), now).drop(ACTION)
    found = insert_new_types(base, seen, now, S.UNKNOWN_EVENT_TYPE).drop(ACTION)
    rows = {r["event_type"]: r for r in found.collect()}
    assert len(rows) == len(S.EVENT_TYPE_SEED) + 1
    assert (rows["NewEvent"]["event_category"], rows["NewEvent"]["is_curated"]) == ("Unknown", False)
    again = insert_new_types(found, seen, now, S.UNKNOWN_EVENT_TYPE)
    assert again.filter(F.col(ACTION) == "insert").count() == 0   # 21: still one row
    curated = spark.createDataFrame(
        [("NewEvent", "Engagement", "New", "curated text", True, True, None)], S.DIM_EVENT_TYPES)
    promoted = {r["event_type"]: r for r in seed_upsert(found, curated, now).collect()}
    n = promoted["NewEvent"]
    assert (n["event_category"], n["event_label"], n["is_core_metric"], n["is_curated"]) == (
        "Engagement", "New", True, True)
    assert n["event_description"] is None                       # 22: description kept
    assert n["discovered_at"] == rows["NewEvent"]["discovered_at"]


def test_insert_ignore(spark):
    table = spark.createDataFrame([("a",), ("b",)], "event_id string")
    batch = spark.createDataFrame([("b",), ("c",)], "event_id string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            assert [r[0] for r in insert_ignore(table, batch, ["event_id"]).collect()] == ["c"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

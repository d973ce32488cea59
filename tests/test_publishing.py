"""Publishing: attempts, commit records, replays, races, compaction, seeds."""

import json

import pytest
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.operators.validate import ValidationError
from eventlake.plans.bronze import backlog, ingest_batch
from eventlake.plans.gold import apply_seeds, bootstrap, bucket_of, curate, run_gold
from eventlake.plans.pipeline import compact, run_pipeline
from eventlake.plans.silver import run_silver
from eventlake.plans.storage import CommitConflict, CommitLog
from eventlake.plans.warehouse import Warehouse
from eventlake.session import scratch_root
from eventlake.sources.landing import land
from eventlake.streaming.bronze_stream import BronzeStream

from tests.test_pipeline import at, cycle, ev, lines


@pytest.fixture()
def wh(spark, root):
    w = Warehouse(spark, root)
    bootstrap(w)
    return w


def envelopes(spark, ids):
    return spark.createDataFrame([(ev(i), n) for n, i in enumerate(ids)], "value string, seq long")


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def test_commit_log_finds_the_newest_and_refuses_a_taken_number(wh):
    log = CommitLog(wh.fs, wh.path("log"))
    assert log.latest() is None
    log.commit(None, {"run_id": 0})
    first = log.latest()
    for n in range(1, 4):
        log.commit(log.latest(), {"run_id": n})
    with pytest.raises(CommitConflict):
        log.commit(first, {"run_id": 9})
    wh.fs.write_text(wh.path("log/_last"), "1", overwrite=True)       # a stale hint
    assert log.latest() == {"run_id": 3, "version": 3}
    wh.fs.write_text(wh.path("log/_last"), "", overwrite=True)        # a broken hint
    assert log.latest()["version"] == 3
    log.commit(log.latest(), {"run_id": 3})                           # the same run, laid out anew
    log.commit(log.latest(), {"run_id": 4})
    assert log.of_run(4)["version"] == 5 and log.of_run(2)["version"] == 2


def test_batch_then_stream_on_one_warehouse(spark, wh):
    ingest_batch(wh, lines(spark, [ev("m1"), ev("m2")]), now=at(1))
    run_silver(wh, at(2))
    land(spark, envelopes(spark, ["s1", "m1"]), wh.path("landing"), "b1")
    (report,) = BronzeStream(wh, wh.path("landing")).run_available(now=at(3))
    assert (report["batch_id"], report["inserted"], report["duplicates"]) == (2, 1, 1)
    assert ids(wh.bronze_events()) == ["m1", "m2", "s1"]
    run_silver(wh, at(4))
    assert ids(wh.silver_events()) == ["m1", "m2", "s1"] and backlog(wh).count() == 0


def test_reset_checkpoint_keeps_history(spark, wh):
    land(spark, envelopes(spark, ["1", "2"]), wh.path("landing"), "b1")
    BronzeStream(wh, wh.path("landing"), checkpoint=wh.path("c1")).run_available(now=at(1))
    land(spark, envelopes(spark, ["3"]), wh.path("landing"), "b2")
    reports = BronzeStream(wh, wh.path("landing"), checkpoint=wh.path("c2")).run_available(now=at(2))
    assert sum(r["inserted"] for r in reports) == 1 and sum(r["duplicates"] for r in reports) == 2
    assert ids(wh.bronze_events()) == ["1", "2", "3"]


def test_replayed_epochs_and_labels_write_nothing(spark, wh):
    batch = lines(spark, [ev(1), "junk"])
    first = ingest_batch(wh, batch, now=at(1), stream=("s", 0))
    again = ingest_batch(wh, batch, now=at(2), stream=("s", 0))
    assert again.pop("repeated") and again == first
    ingest_batch(wh, lines(spark, [ev(2)]), now=at(3), stream=("t", 0))
    assert ingest_batch(wh, batch, now=at(4), stream=("s", 0))["repeated"]
    ingest_batch(wh, lines(spark, [ev(3)]), batch_id="day-1", now=at(5))
    ingest_batch(wh, lines(spark, [ev(4)]), now=at(6))
    assert ingest_batch(wh, lines(spark, [ev(3)]), batch_id="day-1", now=at(7))["inserted"] == 1
    assert [r["batch_id"] for r in wh.bronze_reports().orderBy("batch_id").collect()] == [1, 2, 3, 4]
    assert wh.dead_letters().count() == 1 and wh.bronze_events().count() == 4


def test_failed_epoch_is_replayed(spark, wh, monkeypatch):
    import eventlake.plans.bronze as B

    land(spark, envelopes(spark, ["1", "2"]), wh.path("landing"), "b1")
    stream = BronzeStream(wh, wh.path("landing"))
    real, calls = B._commit, []

    def lost_after_commit(*args):
        report = real(*args)
        calls.append(report)
        raise RuntimeError("writer lost after its commit")

    monkeypatch.setattr(B, "_commit", lost_after_commit)
    with pytest.raises(Exception, match="writer lost"):
        stream.run_available(now=at(1))
    monkeypatch.setattr(B, "_commit", real)
    (report,) = stream.run_available(now=at(2))
    assert report["repeated"] and len(calls) == 1
    assert ids(wh.bronze_events()) == ["1", "2"] and wh.bronze_reports().count() == 1


def test_late_lower_batch_is_processed(spark, wh):
    ingest_batch(wh, lines(spark, [ev(5)]), batch_id=5, now=at(1))
    run_silver(wh, at(2))
    ingest_batch(wh, lines(spark, [ev(3)]), batch_id=3, now=at(3))
    assert not run_silver(wh, at(4))["skipped"]
    assert ids(wh.silver_events()) == ["3", "5"] and backlog(wh).count() == 0


def test_two_bronze_writers(spark, wh, monkeypatch):
    """The loser compares its batch with the winner's and commits after it."""
    import eventlake.plans.bronze as B

    real, raced = B._commit, []

    def race(w, *args):
        if not raced:
            raced.append(True)
            ingest_batch(w, lines(spark, [ev(1, login="winner"), ev(2)]), now=at(1))
        return real(w, *args)

    monkeypatch.setattr(B, "_commit", race)
    report = ingest_batch(wh, lines(spark, [ev(1, login="loser"), ev(3)]), now=at(2))
    assert (report["batch_id"], report["inserted"], report["duplicates"]) == (2, 1, 1)
    logins = {r["event_id"]: json.loads(str(r["full_json"]))["actor"]["login"] for r in wh.bronze_events().collect()}
    assert logins == {"1": "winner", "2": "alice", "3": "alice"}


def test_failed_run_then_curate_publishes_no_rejected_fact(spark, wh):
    cycle(wh, spark, [ev(1, typ="NewEvent")], 1)
    ingest_batch(wh, lines(spark, [ev(2, actor=99, t="2035-01-01T00:00:00Z")]), batch_id=2, now=at(2))
    run_silver(wh, at(3))
    with pytest.raises(ValidationError):
        run_gold(wh, at(4))
    curated = spark.createDataFrame([("NewEvent", "Engagement", "New", None, False, True, None)], S.DIM_EVENT_TYPES)
    run = curate(wh, curated, at(5))
    assert ids(wh.facts()) == ["1"]
    metrics = {r["run_id"]: r for r in wh.run_metrics().collect()}
    assert (metrics[run]["facts_inserted"], metrics[run]["total_facts"]) == (0, 1)
    assert metrics[1]["facts_inserted"] == 1
    with pytest.raises(ValidationError):
        curate(wh, curated.union(curated), at(6))


def test_two_gold_publishers(spark, wh):
    cycle(wh, spark, [ev(1)], 1)
    ingest_batch(wh, lines(spark, [ev(2)]), now=at(2))
    run_silver(wh, at(3))

    def rival(step):
        if step == "validate":
            run_gold(wh, at(4))

    with pytest.raises(CommitConflict):
        run_gold(wh, at(5), on_step=rival)
    assert ids(wh.facts()) == ["1", "2"] and wh.published_run() == 2
    assert {str(r["gold_loaded_at"]) for r in wh.facts().where("event_id = '2'").collect()} == {"2024-02-01 04:00:00"}


def test_one_key_through_all_layers(spark, wh):
    spelled = ['{"id":true,"created_at":"2024-01-02T00:00:00Z"}', '{"id":"True","created_at":"2024-01-02T00:00:00Z"}',
               '{"id":1,"created_at":"2024-01-02T00:00:00Z"}']
    cycle(wh, spark, [*spelled, ev(1)], 1)
    cycle(wh, spark, spelled[::-1], 2)
    assert ids(wh.facts()) == ["1", "True"] == ids(wh.silver_events()) == ids(wh.bronze_events())
    assert backlog(wh).count() == 0


def test_long_names_reach_the_facts_and_are_counted(spark, wh):
    long = json.dumps({"id": "9", "type": "PushEvent", "actor": {"id": 1, "login": "a"}, "repo": {"id": "x", "name": "r" * 300},
                       "created_at": "2024-01-02T00:00:00Z"})
    _, g = cycle(wh, spark, [ev(1), long], 1)
    assert (g["facts_inserted"], g["long_names"]) == (2, 1)
    fact = wh.facts().where("event_id = '9'").first()
    assert fact["repo_id"] == -1 and wh.run_metrics().where("run_id = 1").first()["long_names"] == 1
    assert wh.dim("dim_repos").where("length(repo_name) > 255").count() == 0


def test_an_id_under_another_date_is_ignored(spark, wh):
    """The fact key is global: no insert-ignore by date."""
    cycle(wh, spark, [ev(1)], 1)
    state = wh.silver_state()
    path = wh.attempt("silver/events")
    row = wh.silver_events().drop("run_id").withColumns({
        "event_time": F.lit("2024-01-20").cast("timestamp"), "processed_at": F.lit("2024-02-01 05:00:00").cast("timestamp"), "run_id": F.lit(2)})
    row.write.parquet(path)
    wh.silver_log.commit(state, {**state, "run_id": 2, "events": [*state["events"], {"path": path, "id": 2, "rows": 1}]})
    assert run_gold(wh, at(6))["facts_inserted"] == 0 and wh.facts().count() == 1


def test_untouched_buckets_stay_in_place(spark, wh):
    cycle(wh, spark, [ev(i, actor=i, repo=i) for i in range(1, 40)], 1)
    before = {e["id"]: e["path"] for e in wh.gold_state()["dims"]["dim_actors"]}
    assert len(before) == 8
    cycle(wh, spark, [ev(100, actor=3, login="renamed", repo=3, t="2024-01-09T00:00:00Z")], 2)
    after = {e["id"]: e["path"] for e in wh.gold_state()["dims"]["dim_actors"]}
    bucket = spark.range(1).select(F.lit(3).cast("long").alias("a")).select(bucket_of("a", 8)).first()[0]
    assert {b for b in after if after[b] != before[b]} == {bucket}
    assert wh.dim("dim_actors").where("actor_id = 3").first()["actor_login"] == "renamed"
    assert wh.dim("dim_actors", 1).where("actor_id = 3").first()["actor_login"] == "alice"
    assert wh.dim("dim_actors").count() == 40 == wh.run_metrics().where("run_id = 2").first()["total_actors"]


def test_compaction_changes_nothing_but_folders(spark, wh):
    for n in (1, 2, 3):
        cycle(wh, spark, [ev(10 * n + i, actor=i + 1, t=f"2024-01-0{i + 1}T00:00:00Z") for i in range(5)] + ["junk", '{"id":0}'], n)

    def everything():
        tables = (wh.bronze_events().drop("full_json"), wh.dead_letters(), wh.bronze_reports(), wh.silver_events().drop("payload"),
                  wh.silver_rejects(), wh.facts(), wh.run_metrics(), wh.dim("dim_actors"), wh.dim("dim_actors", 2),
                  wh.silver_events(upto=2, after=1).drop("payload"))
        return [sorted(map(str, t.collect())) for t in tables]

    before = everything()
    merged = compact(wh)
    assert merged["bronze/raw_events"] == merged["gold/fact_events"] == 3
    assert everything() == before and len(wh.gold_state()["fact_events"]) == 1
    assert compact(wh) == {}
    rep, g = cycle(wh, spark, [ev(10), ev(99, actor=7)], 4)
    assert (rep["duplicates"], rep["inserted"], g["facts_inserted"]) == (1, 1, 1)
    assert wh.facts().count() == 16 and backlog(wh).count() == 0
    assert compact(wh)["gold/fact_events"] == 2 and wh.facts().count() == 16


def test_seeds_on_a_live_warehouse(spark, wh):
    cycle(wh, spark, [ev(1, typ="NewEvent"), ev(2)], 1)
    curated = spark.createDataFrame([("PushEvent", "Mine", "Mine", None, False, True, None)], S.DIM_EVENT_TYPES)
    curate(wh, curated, at(3))
    facts, actors = ids(wh.facts()), wh.dim("dim_actors").count()
    apply_seeds(wh, at(4))
    category = lambda: wh.dim("dim_event_types").where("event_type = 'PushEvent'").first()["event_category"]
    assert category() == "Mine"
    apply_seeds(wh, at(5), curated=True)
    assert category() == "Core Activity"
    assert wh.dim("dim_event_types").count() == len(S.EVENT_TYPE_SEED) + 1
    assert (ids(wh.facts()), wh.dim("dim_actors").count()) == (facts, actors)
    assert run_pipeline(wh, at(6))["gold"]["skipped"]


def test_landed_files_of_any_name_are_read(spark, wh, tmp_path):
    import gzip

    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.json").write_text(ev(1) + "\n")
    with gzip.open(folder / "b.jsonl.gz", "wt") as out:
        out.write(ev(2) + "\n")
    BronzeStream(wh, str(folder)).run_available(now=at(1))
    assert ids(wh.bronze_events()) == ["1", "2"]


def test_stream_reports_are_bounded(spark, wh, monkeypatch):
    monkeypatch.setattr("eventlake.streaming.bronze_stream.KEPT_REPORTS", 2)
    stream = BronzeStream(wh, wh.path("landing"), max_files_per_trigger=1)
    for i in range(4):
        land(spark, envelopes(spark, [i]).coalesce(1), wh.path("landing"), f"b{i}")
    assert len(stream.run_available(now=at(1))) == 2
    assert wh.bronze_events().count() == 4


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())

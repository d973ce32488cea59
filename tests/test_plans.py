"""Physical-plan properties the design relies on at scale (explain-based)."""

import contextlib
import io

from pyspark.sql import functions as F

from eventlake.operators import validate
from eventlake.operators.dedupe import latest_by_key
from eventlake.operators.merge import insert_ignore
from eventlake.plans import queries as Q
from eventlake.plans.bronze import ingest_batch
from eventlake.plans.gold import bootstrap, run_gold
from eventlake.plans.silver import run_silver
from eventlake.plans.warehouse import Warehouse

from tests.test_pipeline import at, ev, lines


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def details(p: str) -> str:
    """The numbered node details, bottom-up (scan first)."""
    return p[p.index("\n(1) "):]


def test_latest_by_key_limits_before_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS actor_id", "id AS event_id",
                                      "timestamp_seconds(id) AS event_time")
    p = details(plan(latest_by_key(df, ["actor_id"])))
    partial = p.index("row_number(), 1, Partial")
    assert partial < p.index("Exchange") < p.index("row_number(), 1, Final")


def _warehouse(spark, root):
    wh = Warehouse(spark, root)
    bootstrap(wh)
    ingest_batch(wh, lines(spark, [ev(1), ev(2, actor=2, t="2024-01-20T05:00:00Z")]), batch_id=1, now=at(1))
    run_silver(wh, at(2))
    run_gold(wh, at(3))
    return wh


def test_queries_prune_fact_partitions_and_columns(spark, root):
    wh = _warehouse(spark, root)
    p = plan(Q.daily_volume(wh.facts(), wh.dim_date(), "2024-01-31"))
    assert "PartitionFilters: [isnotnull(date_id" in p and ">= 20240124" in p
    assert "ReadSchema: struct<repo_id:bigint,actor_id:bigint>" in p
    assert "BroadcastExchange" in p            # dim_date, fixed size
    p2 = plan(Q.top_repos(wh.facts(), wh.dim("dim_repos"), wh.dim_date(), "2024-01-31"))
    assert "TakeOrderedAndProject" in p2 and "PartitionFilters: [isnotnull(date_id" in p2
    # pre-aggregation: a partial HashAggregate precedes the first exchange
    d = details(p2)
    assert d.index("HashAggregate") < d.index("hashpartitioning(repo_id")
    # a hot repo is dealt over slices of its actors
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p3 = details(plan(Q.top_repos(wh.facts(), wh.dim("dim_repos"), wh.dim_date(), "2024-01-31")))
        p4 = details(plan(validate.key_and_row_checks(wh.facts(), ["event_id"], "dup", validate.hour_in_range())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(repo_id" in p3 and ", slice" in p3
    # only the key and its count are shuffled by key
    keyed = [line for line in p4.splitlines() if "hashpartitioning(event_id" in line]
    assert len(keyed) == 1 and "ReadSchema: struct<event_id:string>" in p4


def test_small_batch_dedupe_never_shuffles_the_store(spark, root, tmp_path):
    wh = _warehouse(spark, root)
    store = wh.bronze_events()
    written = str(tmp_path / "batch")
    spark.createDataFrame([("1",), ("9",)], "event_id string").write.parquet(written)
    p = plan(insert_ignore(store, spark.read.parquet(written), ["event_id"]))
    assert "ReadSchema: struct<event_id:string>" in details(p)
    # the stored ids meet the batch's keys, broadcast by their size, before any shuffle
    tree = p[:p.index("\n(1) ")]
    between = tree[tree.index("BroadcastHashJoin LeftSemi"):tree.index("Scan parquet", tree.index("BroadcastHashJoin LeftSemi"))]
    assert "Exchange" not in between


def test_gold_batch_filter_reaches_the_scan(spark, root):
    wh = _warehouse(spark, root)
    from eventlake.operators.conform import conform
    v = conform(wh.silver_events()).where(
        F.col("processed_at") > F.lit("2024-02-01 00:00:00").cast("timestamp"))
    p = plan(v)
    pushed = p.split("PushedFilters: [")[1].split("\n")[0]
    assert "GreaterThan(processed_at" in pushed and "IsNotNull(event_time)" in pushed
    assert "payload" not in p.split("ReadSchema:")[1].split("\n")[0]

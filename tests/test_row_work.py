"""The work per row and per task of parsing and extraction."""

import random

from pyspark.sql import functions as F

from eventlake.operators import validate as V
from eventlake.operators.classify import _END, classify
from eventlake.operators.extract import extract
from eventlake.operators.parallel import spread
from eventlake.plans.bronze import ingest_batch
from eventlake.plans.warehouse import Warehouse
from eventlake.session import configure


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_follow_the_size_of_the_input(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("value")).coalesce(1).write.parquet(path)
    rows = spark.read.parquet(path)
    wide = spread(rows, task_bytes=100_000)
    assert wide.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    assert wide.count() == 40_000
    assert spread(rows).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism  # small: the cores' share
    assert spread(spark.createDataFrame([(1,)], "a int"), task_bytes=1).rdd.getNumPartitions() <= 4


def _two_parses(spark, texts):
    """The rule as it stands in ``classify``: one element of an array, and the member of an object."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    return {r["i"]: r["whole"] for r in rows.selectExpr(
        "i", "try_variant_get(try_parse_json(concat('[', value, ']')), '$', 'array<variant>') AS a",
        "try_parse_json(concat('{\"x\":', value, '}')) IS NOT NULL AS m").selectExpr(
        "i", "CASE WHEN m AND size(a) = 1 THEN to_json(a[0]) END AS whole").collect()}


def test_a_line_parsed_once_comes_out_as_by_two_parses(spark):
    configure(spark)
    obj = '{"id":"7","type":"PushEvent"}'
    escaped = "".join(f"\\u{ord(c):04x}" for c in _END)
    texts = ["", " ", "null", "1", "[1,2]", "[]", obj, f" {obj}\t\r", obj + obj, f"{obj} xx", f"{obj}] xx}}", f"{obj}}} xx]",
             f"{obj},{obj}", f"{obj},", f",{obj}", f"{obj},\"", f"{obj},\"{_END}\"] xx", f"{obj},\"{escaped}\"] xx", f"{obj},\"{_END}",
             f'{{"id":"{_END}"}}', f'{{"id":"{escaped}"}}', '{"id":"\\u0000"}', '{"id":"\\\\u0000"}', '{"id":"a', "[", "]", "],[", '"', "1],[1", "1]", "1}"]
    rnd = random.Random(3)
    texts += ["".join(rnd.choices([obj, _END, f'"{_END}"', ",", "[", "]", "{", "}", '"', "\\", " ", "1"], k=rnd.randint(1, 6))) for _ in range(300)]
    whole = _two_parses(spark, texts)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    found = {r["i"]: r["text"] for r in classify(rows).select("i", F.expr("to_json(full_json)").alias("text")).collect()}
    assert found == whole
    assert sum(t is not None for t in whole.values()) > 8
    # An ordinary line is parsed once: what the other ways need is asked for only of the rest.
    assert "__marked" in classify(rows)._jdf.queryExecution().analyzed().toString()


def test_lines_are_kept_for_rejects_only(spark, root, monkeypatch):
    wh, seen = Warehouse(spark, root), []
    monkeypatch.setattr(wh.fs, "delete", lambda p, *a: seen.append(p))
    lines = spark.createDataFrame([('{"id":"1"}',), ("damaged",)], "value string")
    report = ingest_batch(wh, lines, batch_id=1, now="2024-01-01 00:00:00")
    assert (report["inserted"], report["errors"]) == (1, 1)
    assert [r["failed_payload"] for r in wh.dead_letters().collect()] == ["damaged"]
    assert {r["value"] for r in spark.read.parquet(seen[0]).collect()} == {None, "damaged"}


def test_wide_stages_stay_below_the_method_size_that_is_compiled(spark, tmp_path):
    configure(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_key_and_row_checks_make_their_rows_once(spark, tmp_path):
    configure(spark)
    path = str(tmp_path / "lines")
    lines = ['{"id":"1","type":"A"}', '{"id":"1"}', '{"id":"2","type":null}', "damaged", '{"type":"A"}', "3"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.parquet(path)
    rows = extract(classify(spark.read.parquet(path)))
    how = dict(keys=["event_id"], dup_name="duplicate_event_id", checks=V.not_null(["event_type"]), where=F.col("reject_reason").isNull())
    once, twice = (V.key_and_row_checks(rows, **how, one_pass=p) for p in (True, False))
    assert (_plan(once).count("FileScan"), _plan(twice).count("FileScan")) == (1, 2)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("duplicate_event_id", 1), ("null_event_type", 2)]
    none = V.key_and_row_checks(rows.limit(0), **how, one_pass=True)
    assert sorted(map(tuple, none.collect())) == [("duplicate_event_id", 0), ("null_event_type", 0)]

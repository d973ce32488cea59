"""Clustered facts: what lookups open, by the files' own statistics."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventlake.plans import layout
from eventlake.plans.layout import clustered, morton
from eventlake.plans.pipeline import compact
from eventlake.plans.warehouse import Warehouse

from tests.test_ids_tiers import ids
from tests.test_pipeline import cycle, ev


def facts(spark, n=40_000):
    """Two dates; one repo holds a third of the rows; ids of very uneven sizes."""
    return spark.range(n).selectExpr(
        "id", "int(20240101 + id % 2) AS date_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE pmod(xxhash64(id, 1), 900) * pmod(xxhash64(id, 1), 900) END AS repo_id",
        "CASE WHEN id % 50 = 0 THEN -1 ELSE pmod(xxhash64(id, 2), 3000) * 1000003 END AS actor_id", "timestamp_seconds(id) AS event_time")


def ranges(folder, column):
    """(least, greatest) of a column in every file below."""
    out = []
    for file in sorted(folder.glob("**/*.parquet")):
        meta = pq.ParquetFile(file).metadata
        at = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return out


def test_lookups_by_either_key_open_few_files(spark, tmp_path):
    df = facts(spark)
    clustered(df, 40_000, file_rows=40_000 // 128).write.partitionBy("date_id").parquet(str(tmp_path / "f"))
    day = tmp_path / "f" / "date_id=20240101"
    for column in ("repo_id", "actor_id"):
        files = ranges(day, column)
        assert len(files) >= 50
        asked = [r[0] for r in df.where("date_id = 20240101 AND repo_id <> 7 AND actor_id <> -1").select(column).distinct().orderBy(F.xxhash64(column)).limit(200).collect()]
        opened = [sum(lo <= x <= hi for lo, hi in files) for x in asked]
        assert max(opened) < len(files) / 4, (column, max(opened), len(files))
    # the hot repo's rows are spread over many files, none of which holds most of them
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in day.glob("*.parquet")]
    assert max(sizes) < 4 * sum(sizes) / len(sizes)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "f")).select(df.columns).collect())) == sorted(map(tuple, df.collect()))


def test_morton_order(spark):
    places = spark.range(64).select(F.expr("int(id % 8)").alias("x"), F.expr("int(id div 8)").alias("y"))
    got = {(r["x"], r["y"]): r["z"] for r in places.withColumn("z", morton(F.col("x"), F.col("y"), 3)).collect()}
    want = {(x, y): sum(((x >> i & 1) << 2 * i + 1) + ((y >> i & 1) << 2 * i) for i in range(3)) for x in range(8) for y in range(8)}
    assert got == want and sorted(got.values()) == list(range(64))


@pytest.mark.parametrize("file_rows", [3, layout.FILE_ROWS])
def test_merged_facts_are_clustered_and_whole(spark, root, monkeypatch, file_rows):
    from eventlake.plans.gold import bootstrap

    monkeypatch.setattr(layout, "FILE_ROWS", file_rows)
    wh = Warehouse(spark, root)
    bootstrap(wh)
    for n in (1, 2):
        cycle(wh, spark, [ev(10 * n + i, actor=i, repo=i % 3, t=f"2024-01-0{i % 2 + 1}T00:00:00Z") for i in range(10)], n)
    before = sorted(map(str, wh.facts().collect()))
    compact(wh)
    assert sorted(map(str, wh.facts().collect())) == before and len(ids(wh.facts())) == 20
    found = wh.facts().where("repo_id = 2 AND date_id = 20240101")
    assert found.count() == sum(i % 3 == 2 and i % 2 == 0 for i in range(10)) * 2
    assert clustered(wh.facts().limit(0), 0).count() == 0

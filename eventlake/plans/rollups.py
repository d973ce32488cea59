"""Aggregates of the facts that are kept per gold run (Q-1, Q-3, Q-5, H-1, H-3, H-4).

A run writes, with its facts, what these questions need of them:

* ``hours``: events per (date, hour, type), those on the unknown actor and
  repo, and the newest processing time. Counts add, the time is a maximum.
* ``ids``: per date, the distinct actors and repos as bitmaps of 2**15 ids
  each. Bitmaps of several runs are or-ed, so distinct counts stay exact
  however late an event comes and however runs are merged.

A record names them like any table's folders; a failed or retried run's are in
no record. Readers merge the folders' rows; tiers merge the folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import schema as S

ROLLUPS = T.StructType([
    T.StructField("date_id", T.IntegerType()), T.StructField("event_hour", T.IntegerType()), T.StructField("event_type", T.StringType()),
    T.StructField("events", T.LongType()), T.StructField("unknown_actors", T.LongType()), T.StructField("unknown_repos", T.LongType()),
    T.StructField("newest", T.TimestampType()), T.StructField("what", T.StringType()), T.StructField("id_bucket", T.LongType()),
    T.StructField("bits", T.BinaryType()), T.StructField("kind", T.StringType()),
])
HOURS = ["date_id", "event_hour", "event_type", "events", "unknown_actors", "unknown_repos", "newest"]
IDS = ["date_id", "what", "id_bucket", "bits", "events"]


def hours(facts: DataFrame) -> DataFrame:
    """Facts -> ``hours`` rows."""
    return facts.groupBy("date_id", "event_hour", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("actor_id") == S.UNKNOWN_ACTOR_ID).alias("unknown_actors"),
        F.count_if(F.col("repo_id") == S.UNKNOWN_REPO_ID).alias("unknown_repos"),
        F.max("silver_processed_at").alias("newest"))


def ids(facts: DataFrame) -> DataFrame:
    """Facts -> ``ids`` rows: a bitmap per (date, actors or repos, bucket of
    ids). Ids may be negative: each has a bucket and a bit of its own."""
    each = facts.selectExpr("date_id", "inline(array(struct('actor' AS what, actor_id AS id), struct('repo' AS what, repo_id AS id)))")
    return each.groupBy("date_id", "what", F.bitmap_bucket_number("id").alias("id_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"), F.count(F.lit(1)).alias("events"))


def merged_hours(rows: DataFrame) -> DataFrame:
    """``hours`` rows of any runs, one per (date, hour, type)."""
    return rows.groupBy("date_id", "event_hour", "event_type").agg(
        *(F.sum(c).alias(c) for c in ("events", "unknown_actors", "unknown_repos")), F.max("newest").alias("newest"))


def merged_ids(rows: DataFrame) -> DataFrame:
    """``ids`` rows of any runs, one per (date, actors or repos, bucket)."""
    return rows.groupBy("date_id", "what", "id_bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("events").alias("events"))


def _whole(rows: DataFrame, kind: str) -> DataFrame:
    made = set(rows.columns)
    return rows.select(*((F.col(f.name) if f.name in made else F.lit(kind if f.name == "kind" else None).cast(f.dataType)).alias(f.name)
                         for f in ROLLUPS.fields))


def rollups(facts: DataFrame) -> DataFrame:
    """Both kinds as rows of one table."""
    return _whole(hours(facts), "hours").unionByName(_whole(ids(facts), "ids"))


def merged(rows: DataFrame) -> DataFrame:
    """Rows of several runs merged into rows of the same table."""
    return _whole(merged_hours(rows.where("kind = 'hours'")), "hours").unionByName(_whole(merged_ids(rows.where("kind = 'ids'")), "ids"))


def write(rows: DataFrame, path: str) -> None:
    rows.write.partitionBy("kind").parquet(path)

"""The event fixture derived from the driver's ``events`` table.

``FIXTURE_SQL`` injects every branch of the warehouse semantics (missing and
duplicate ids, sentinels, overflow, late arrivals, unparseable times, ...)
into the events, row for row: it keeps every event and only rewrites values.
The same text runs in Spark and in DuckDB, which makes it the common input
of the Spark queries and of their SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.parallel import EVENT_TASK_BYTES, spread

# The fixture text, run verbatim by both engines over `events`.
FIXTURE_SQL = """
SELECT event_id AS seq,
 CASE WHEN event_id % 211 = 5 THEN NULL WHEN event_id % 50 = 49 THEN CAST(event_id - 1 AS STRING) ELSE CAST(event_id AS STRING) END AS id,
 CASE WHEN event_id % 101 = 3 THEN NULL WHEN event_type='click' THEN 'PushEvent' WHEN event_type='view' THEN 'WatchEvent' WHEN event_type='purchase' THEN 'PullRequestEvent' WHEN event_type='signup' THEN 'CreateEvent' ELSE 'SponsorshipEvent' END AS type,
 CASE WHEN user_id % 25 = 7 THEN 'ghost' WHEN event_id % 307 = 11 THEN '99999999999999999999' ELSE CAST(user_id + 1000 AS STRING) END AS actor_id,
 CASE WHEN event_id % 89 = 4 THEN NULL ELSE concat('user', CAST(user_id AS STRING), '_d', CAST(CAST(FLOOR(EXTRACT(DAY FROM ts) / 10.0) AS INT) AS STRING)) END AS actor_login,
 CASE WHEN k % 17 = 3 THEN NULL ELSE CAST(k + 5000 AS STRING) END AS repo_id,
 CASE WHEN k % 11 = 0 THEN concat('proj', CAST(k AS STRING)) WHEN k % 13 = 5 THEN concat('own', CAST(k AS STRING), '/a/b') ELSE concat('own', CAST(k % 7 AS STRING), '/proj', CAST(k AS STRING)) END AS repo_name,
 CASE WHEN k % 5 = 0 THEN CAST(9000 + k % 10 AS STRING) END AS org_id,
 CASE WHEN k % 5 = 0 THEN concat('org', CAST(k % 10 AS STRING)) END AS org_login,
 CASE WHEN event_id % 97 = 13 THEN NULL ELSE date_trunc('second', ts) END AS event_time,
 CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN FALSE ELSE TRUE END AS is_public,
 CASE WHEN event_id % 17 = 0 THEN 4 WHEN EXTRACT(DAY FROM ts) <= 10 THEN 1 WHEN EXTRACT(DAY FROM ts) <= 20 THEN 2 ELSE 3 END AS arrival_batch,
 k
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM {events})
"""

ARRIVAL_BATCHES = (1, 2, 3, 4)
# Silver processing time of arrival batch b is base + b hours.
PROCESSED_AT_BASE = "2024-02-01 00:00:00"
AS_OF_DATE = "2024-01-31"
AS_OF_TS = "2024-01-30 00:00:00"
# The repo and the actor that the lookup query asks for.
LOOKED_UP = {"repo": 5010, "actor": 1010}
CREATED_AT_UNPARSEABLE = "not-a-time"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def fixture(events: DataFrame) -> DataFrame:
    """``fx``: one row per event with the injected cases (FIXTURES §3).

    The per-row JSON work downstream is CPU-bound, so a single-file input
    is spread over the session's cores first.
    """
    return events.sparkSession.sql(FIXTURE_SQL, events=spread(events, task_bytes=EVENT_TASK_BYTES))


def envelope(fx: DataFrame) -> DataFrame:
    """Nested JSON envelope text per fixture row: ``value``, ``seq``,
    ``arrival_batch``. NULL fields are written as explicit JSON nulls; a
    missing time becomes an unparseable ``created_at``."""
    env = F.struct(
        F.col("id").alias("id"),
        F.col("type").alias("type"),
        F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login")).alias("actor"),
        F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
        F.when(F.col("org_id").isNotNull(),
               F.struct(F.col("org_id").alias("id"), F.col("org_login").alias("login"))).alias("org"),
        F.struct(F.col("k").alias("k")).alias("payload"),
        F.col("is_public").alias("public"),
        F.coalesce(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                   F.lit(CREATED_AT_UNPARSEABLE)).alias("created_at"),
    )
    return fx.select(F.to_json(env, {"ignoreNullFields": "false"}).alias("value"),
                     "seq", "arrival_batch")


def corrupt(lines: DataFrame) -> DataFrame:
    """Damage some lines for the dead-letter checks: a truncated object
    (``not_json``) or a JSON array (``not_object``)."""
    v = (F.when(F.col("seq") % 113 == 2, F.substring("value", 1, 20))
         .when(F.col("seq") % 127 == 9, F.lit("[1,2]"))
         .otherwise(F.col("value")))
    return lines.withColumn("value", v)


#: Kinds of hostile lines, by event_id % EDGE_KINDS; the rest are ordinary.
EDGE_KINDS = 23


def edge_lines(events: DataFrame) -> DataFrame:
    """A line per event, many of them hostile: ``value``, ``seq``.

    Damaged or double JSON, padded lines, falsy, boolean and over-long ids,
    long names with a bad repo id, times with offsets and fractions.
    """
    seq, kind = F.col("event_id"), F.col("event_id") % EDGE_KINDS
    plain = F.concat(F.lit("e"), seq.cast("string"))
    quoted = F.concat(F.lit('"'), plain, F.lit('"'))
    key = (F.when(kind == 6, F.lit('""')).when(kind == 7, F.lit("0")).when(kind == 8, F.lit("true"))
           .when(kind == 9, F.lit('"True"')).when(kind == 13, F.concat(F.lit('"'), F.lpad(plain, 60, "x"), F.lit('"')))
           .otherwise(quoted))
    repo = F.when(kind == 10, F.concat(F.lit('{"id":"none","name":"'), F.lpad(plain, 300, "n"), F.lit('"}'))).otherwise(
        F.lit('{"id":7,"name":"own/proj"}'))
    time = (F.when(kind == 11, F.lit("2024-01-05T10:00:00+05:30")).when(kind == 12, F.lit("2024-01-05T10:00:00.250Z"))
            .otherwise(F.lit("2024-01-05T10:00:00Z")))
    line = F.concat(F.lit('{"id":'), key, F.lit(',"type":"PushEvent","actor":{"id":'), seq.cast("string"),
                    F.lit(',"login":"u"},"repo":'), repo, F.lit(',"created_at":"'), time, F.lit('"}'))
    value = (F.when(kind == 0, F.substring(line, 1, 20)).when(kind == 1, F.lit("[1,2]"))
             .when(kind == 2, F.concat(F.lit(" "), line, F.lit("\t\r"))).when(kind == 3, F.concat(line, line))
             .when(kind == 4, F.concat(line, F.lit(" xx"))).when(kind == 5, F.concat(line, F.lit("] xx}")))
             .when(kind == 14, F.concat(line, F.lit(","), line)).otherwise(line))
    return spread(events, task_bytes=EVENT_TASK_BYTES).select(value.alias("value"), seq.alias("seq"))


def json_array_documents(events: DataFrame, size: int = 1000) -> DataFrame:
    """JSON-array documents of up to ``size`` envelopes each: ``value``, ``doc``."""
    item = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), F.lit("PushEvent").alias("type"),
        F.struct(F.col("user_id").alias("id")).alias("actor")))
    return events.select(F.floor(F.col("event_id") / size).cast("long").alias("doc"), "event_id", item.alias("item")).groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "item"))).alias("items")).select(
        F.concat(F.lit("[\n"), F.array_join("items.item", ",\n"), F.lit("\n]")).alias("value"), "doc")


def processed_at(batch: int) -> str:
    """Silver ``now`` of arrival batch ``batch`` as ``yyyy-MM-dd HH:mm:ss``."""
    return f"2024-02-01 {batch:02d}:00:00"

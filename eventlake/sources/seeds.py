"""SRC-6: seed rows (sentinels and curated event types) as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake import schema as S


def event_type_seed(spark: SparkSession) -> DataFrame:
    rows = [(t, c, lbl, d, core, True, None) for t, c, lbl, d, core in S.EVENT_TYPE_SEED]
    return spark.createDataFrame(rows, S.DIM_EVENT_TYPES)


def actor_sentinel(spark: SparkSession) -> DataFrame:
    rows = [(S.UNKNOWN_ACTOR_ID, S.UNKNOWN_ACTOR_LOGIN, None, S.EPOCH)]
    return spark.createDataFrame(rows, S.DIM_ACTORS)


def repo_sentinel(spark: SparkSession) -> DataFrame:
    rows = [(S.UNKNOWN_REPO_ID, S.UNKNOWN_REPO_NAME, S.UNKNOWN_REPO_OWNER,
             S.UNKNOWN_REPO_PROJECT, None, S.UNKNOWN_REPO_ORG_LOGIN, None, S.EPOCH)]
    return spark.createDataFrame(rows, S.DIM_REPOS)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)

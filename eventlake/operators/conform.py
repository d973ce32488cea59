"""PRJ-3: the conformed view over silver (defaults, safe casts, date key).

A pure function of the silver DataFrame, so Catalyst inlines it into every
consumer: the ``processed_at > watermark`` filter of a gold run is pushed
through it into the Parquet scan, and ``payload`` is never read (PRJ-5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventlake import schema as S
from eventlake.functions.rules import date_key_sql, digits_or_sql


def conform(silver: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """silver.events -> v_events. Rows without an event_time are hidden (FLT-2).

    ``keep`` passes extra columns (e.g. ``run_id``) through unchanged.
    """
    return silver.where("event_time IS NOT NULL").selectExpr(
        "event_id",
        "event_time",
        f"coalesce(event_type, '{S.UNKNOWN_EVENT_TYPE}') AS event_type",
        "processed_at",
        f"{date_key_sql('event_time')} AS date_id",
        "CAST(hour(event_time) AS INT) AS event_hour",
        f"{digits_or_sql('actor_id', str(S.UNKNOWN_ACTOR_ID))} AS actor_id",
        f"coalesce(actor_login, '{S.UNKNOWN_ACTOR_LOGIN}') AS actor_login",
        f"{digits_or_sql('repo_id', str(S.UNKNOWN_REPO_ID))} AS repo_id",
        f"coalesce(repo_name, '{S.UNKNOWN_REPO_NAME}') AS repo_name",
        f"{digits_or_sql('org_id', 'NULL')} AS org_id",
        f"coalesce(org_login, '{S.DEFAULT_ORG_LOGIN}') AS org_login",
        "coalesce(is_public, true) AS is_public",
        *keep,
    )

"""DED-1 / DED-3: keep one row per key.

Both are ``row_number() = 1`` over a key window. Spark plans this with a
partial WindowGroupLimit *before* the shuffle, so a hot key contributes at
most one row per map task to the exchange: skew on the key does not turn
into one oversized reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

_RN = "__rn"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per ``keys`` under ``order`` (SQL sort items, e.g.
    ``"event_time DESC"``; ties must be broken by them)."""
    w = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) AS {_RN}"
    return df.selectExpr("*", w).where(f"{_RN} = 1").drop(_RN)


def first_arrival(df: DataFrame, key: str, arrival: Sequence[str]) -> DataFrame:
    """DED-1: the earliest arrival of every key wins."""
    return first_per_key(df, [key], [f"{c} ASC" for c in arrival])


def latest_by_key(
    df: DataFrame, keys: Sequence[str], time_col: str = "event_time", tie_col: str = "event_id"
) -> DataFrame:
    """DED-3: newest row per key; equal times go to the highest ``tie_col``.

    Same result as ``DISTINCT ON (key) ... ORDER BY key, time DESC`` with a
    deterministic tie-break.
    """
    return first_per_key(df, keys, [f"{time_col} DESC", f"{tie_col} DESC"])

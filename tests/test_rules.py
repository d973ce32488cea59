"""FN-3/4 (digits), FN-17 (ISO time), FN-9 (date key), FN-10..12 (owner/project)."""

import datetime as dt

from pyspark.sql import functions as F

from eventlake.functions.rules import (
    date_key_sql, digits_or_sql, iso_from_parts_sql, iso_parts_sql, owner_project_sql,
)


def iso_sql(x):
    return iso_from_parts_sql(f"({iso_parts_sql(x)})")


def _one(spark, sql, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(F.expr(sql)).collect()]


def test_digits_or_sentinel(spark):
    got = _one(spark, digits_or_sql("x", "-1"),
               ["123", "12a", "123\n", "99999999999999999999", None, "0", "", " 1"])
    assert got == [123, -1, -1, -1, -1, 0, -1, -1]


def test_digits_or_null_default(spark):
    assert _one(spark, digits_or_sql("x", "NULL"), ["77", "x", None]) == [77, None, None]


def test_iso_timestamp_shapes(spark):
    utc = dt.timezone.utc
    values = [
        "2024-01-01T23:59:59Z",          # 14
        "2024-01-01T10:00:00+05:30",     # 13, offset
        "2024-01-01T10:00:00.123456Z",   # 13, microseconds
        "2024-01-01",                    # 13, date only
        "garbage", "2026", "2026-13-01T00:00:00Z", "T08:49", "",  # 12
        "2024-01-01T10:00:00.12Z",       # two fraction digits: rejected as in Python
        "2024-01-01 10:00",              # any separator, minutes only
        "2024-01-01Z",                   # Z -> +00:00 reads as separator + 00:00
    ]
    got = _one(spark, iso_sql("x"), values)
    want = [
        dt.datetime(2024, 1, 1, 23, 59, 59, tzinfo=utc),
        dt.datetime(2024, 1, 1, 4, 30, 0, tzinfo=utc),
        dt.datetime(2024, 1, 1, 10, 0, 0, 123456, tzinfo=utc),
        dt.datetime(2024, 1, 1, 0, 0, 0, tzinfo=utc),
        None, None, None, None, None, None,
        dt.datetime(2024, 1, 1, 10, 0, 0, tzinfo=utc),
        dt.datetime(2024, 1, 1, 0, 0, 0, tzinfo=utc),
    ]
    got = [g.replace(tzinfo=utc) if g is not None else None for g in got]
    assert got == want


def test_date_key_and_hour(spark):
    df = spark.createDataFrame([("2024-01-01T23:59:59Z",)], "x string")
    t = iso_sql("x")
    r = df.select(F.expr(date_key_sql(f"({t})")).alias("d"), F.expr(f"hour({t})").alias("h")).first()
    assert (r["d"], r["h"]) == (20240101, 23)


def test_owner_project(spark):
    df = spark.createDataFrame([(v,) for v in ["a", "a/b", "a/b/c", "/b", "a/"]], "x string")
    o, p = owner_project_sql("x")
    got = [(r[0], r[1]) for r in df.select(F.expr(o), F.expr(p)).collect()]
    unk = ("unknownowner", "unknownproject")
    assert got == [unk, ("a", "b"), unk, ("", "b"), ("a", "")]

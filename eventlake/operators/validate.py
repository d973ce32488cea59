"""VAL-1..4: constraint checks as distributed aggregates.

Every check returns a long table ``(check_name STRING, violations BIGINT)``
so several checks union into one report and a publish can be refused with
one small collect (a handful of rows, never the data).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _row(name: str, value: Column) -> list[Column]:
    return [F.lit(name).alias("check_name"), F.coalesce(value, F.lit(0)).cast("bigint").alias("violations")]


def union(parts: Sequence[DataFrame]) -> DataFrame:
    """The rows of several checks as one report."""
    return reduce(DataFrame.unionByName, parts)


def fk_violations(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """VAL-1: fact rows whose foreign key is missing from its dimension.

    ``dims`` maps a check name to ``(dimension, key column)``; the fact has a
    column of the same name. Every check scans its own key column of the
    facts, pre-aggregated to one row per distinct key (partial aggregation, so
    a hot key costs one row per map task); one anti-join on
    ``(check_name, key)`` then meets the dimensions' key columns. One row per
    check comes back, zero included.
    """
    facts = union([
        fact.groupBy(F.col(key).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("check_name"), "k", "n")
        for name, (_dim, key) in dims.items()])
    keys = union([dim.select(F.lit(name).alias("check_name"), F.col(key).cast("string").alias("k"))
                   for name, (dim, key) in dims.items()])
    missing = facts.join(keys, ["check_name", "k"], "left_anti").groupBy("check_name").agg(
        F.sum("n").alias("n"))
    names = fact.sparkSession.createDataFrame([(n,) for n in dims], "check_name string")
    return names.join(missing, "check_name", "left").select(*_row_named("check_name", F.col("n")))


def _row_named(name_col: str, value: Column) -> list[Column]:
    return [F.col(name_col), F.coalesce(value, F.lit(0)).cast("bigint").alias("violations")]


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """VAL-2: number of key values held by more than one row."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dup.agg(*_row(name, F.count(F.lit(1))))


def row_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """VAL-3 / VAL-4: count rows failing each boolean condition, in one pass.

    ``checks`` maps a name to a condition that is TRUE for a violation.
    """
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return union([counts.select(*_row(n, F.col(n))) for n in checks])


def key_and_row_checks(
    df: DataFrame, keys: Sequence[str], dup_name: str, checks: Mapping[str, Column],
    where: Column | None = None, one_pass: bool = False,
) -> DataFrame:
    """VAL-2 and VAL-3/4 as one report.

    Row checks are counted map-side and never shuffled; only the keys, with
    a row count each (partial aggregation, so a hot key does not concentrate
    rows), are. With ``one_pass`` the checks are counted with the keys instead:
    more is shuffled, but ``df``, which may be costly to make, is made once.
    ``where`` restricts all checks to the rows it accepts.
    """
    ok = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    failing = [F.count_if(ok & F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()]
    if one_pass:
        both = df.groupBy(*keys).agg(F.count_if(ok).alias("__n"), *failing).agg(
            F.count_if(F.col("__n") > 1).alias(dup_name), *(F.sum(n).alias(n) for n in checks))
        return _long(both, [dup_name, *checks])
    counts = df.agg(*failing)
    per_key = df.groupBy(*keys).agg(F.count_if(ok).alias("__n"))
    repeated = per_key.agg(F.count_if(F.col("__n") > 1).alias(dup_name))
    return _long(repeated, [dup_name]).unionByName(_long(counts, list(checks)))


def _long(one: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns of a single row as a report."""
    return one.select(F.explode(F.array(*[F.struct(*_row(n, F.col(n))) for n in names])).alias("x")).select("x.*")


def not_null(cols: Sequence[str]) -> dict[str, Column]:
    return {f"null_{c}": F.col(c).isNull() for c in cols}


def too_long(limits: Mapping[str, int]) -> dict[str, Column]:
    return {f"too_long_{c}": F.length(F.col(c)) > n for c, n in limits.items()}


def hour_in_range(col: str = "event_hour") -> dict[str, Column]:
    return {f"range_{col}": (F.col(col) < 0) | (F.col(col) > 23)}


class ValidationError(RuntimeError):
    """Raised when a staged run breaks a declared constraint."""

    def __init__(self, failures: dict[str, int]):
        super().__init__(f"constraint violations: {failures}")
        self.failures = failures


def raise_on(counts: Mapping[str, int]) -> dict[str, int]:
    """Raise ``ValidationError`` if any named count is non-zero."""
    failures = {k: int(v) for k, v in counts.items() if v}
    if failures:
        raise ValidationError(failures)
    return dict(counts)


def assert_clean(report: DataFrame) -> dict[str, int]:
    """Collect the (few) report rows; raise if any check found violations."""
    return raise_on({r["check_name"]: int(r["violations"]) for r in report.collect()})

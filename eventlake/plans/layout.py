"""Clustered layout of merged facts: lookups by repo or by actor read few files.

Inside a date, facts lie in Morton order of (repo, actor): each id is placed
among quantiles of its column, and the bits of the two places alternate. Files
are ranges of that order, so each holds a patch of both columns and its
statistics exclude most lookups by either. Of n files of a date a lookup by one
key opens about the root of n. Quantiles rather than the ids' own bits keep the
patches even however the ids are distributed; a repo that holds a third of the
rows has one place, and its rows are told apart by their actors.

Applied when tiers are merged. What a run writes is sorted by date and repo.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a file of merged facts, about.
FILE_ROWS = 2_000_000
#: Bits of a place: 2**BITS quantiles of each column.
BITS = 6


def _place(column: str, cuts: list[int]) -> Column:
    return F.size(F.filter(F.array(*(F.lit(c).cast("long") for c in cuts)), lambda c: c < F.col(column)))


def morton(left: Column, right: Column, bits: int = BITS) -> Column:
    """Two places with their bits in turn."""
    out = F.lit(0)
    for i in range(bits):
        for place, at in ((left, 2 * i + 1), (right, 2 * i)):
            out = out + F.shiftleft(F.shiftright(place, i).bitwiseAND(F.lit(1)), at)
    return out


def clustered(facts: DataFrame, rows: int, file_rows: int | None = None) -> DataFrame:
    """``facts`` dealt over ranges of (date, Morton order) and sorted."""
    file_rows = file_rows or FILE_ROWS
    n = 1 << BITS
    quantiles = F.lit([i / n for i in range(1, n)])
    cuts = facts.agg(*(F.percentile_approx(c, quantiles, 1000).alias(c) for c in ("repo_id", "actor_id"))).first()
    places = [_place(c, cuts[c] or []) for c in ("repo_id", "actor_id")]
    keyed = facts.withColumns({"__repo": places[0], "__actor": places[1]}).withColumn("__z", morton(F.col("__repo"), F.col("__actor")))
    order = ["date_id", "__z", "repo_id", "actor_id"]
    ranged = keyed.repartitionByRange(max(1, -(-rows // file_rows)), *order).sortWithinPartitions(*order, "event_time")
    return ranged.drop("__repo", "__actor", "__z")

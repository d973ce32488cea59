"""Parallelism guard for CPU-heavy row work (JSON parse / extraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Stored bytes of a task, about. Of the narrow ``events`` rows, each of which
#: becomes a line of JSON, a task takes fewer.
TASK_BYTES = 32 << 20
EVENT_TASK_BYTES = 2 << 20


def tasks_for(df: DataFrame, task_bytes: int) -> int:
    """Tasks of ``task_bytes`` for a scan, by the planner's size of it; 1 if it
    knows none (rows of an RDD count as larger than anything)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return 1 if size >= 1 << 50 else -(-size // task_bytes)


def spread(df: DataFrame, min_partitions: int | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Round-robin repartition ``df`` only if it has fewer partitions than
    ``min_partitions``. By default these are the session's default parallelism,
    or more where a task would get above ``task_bytes``: a task's time so does
    not grow with the input.

    A few small input files become one task each; parsing them would then
    use a fraction of the cluster. Inputs with enough splits
    are returned untouched (no shuffle). Apply it to scans only: asking a
    plan with a shuffle for its partitions would run that shuffle. Apply it
    after anything that depends on scan order (arrival positions) has been
    computed.
    """
    spark = df.sparkSession
    target = min_partitions or max(spark.sparkContext.defaultParallelism, tasks_for(df, task_bytes))
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)

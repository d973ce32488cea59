"""Run independent Spark jobs of one step side by side."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from eventlake.session import describe


def run_concurrently(spark: SparkSession, label: str, jobs: dict[str, Callable[[], object]],
                     ms: dict | None = None) -> dict:
    """Submit each named callable from its own driver thread and wait for all.

    Each callable issues its own Spark actions (writes); the scheduler runs
    them side by side, which overlaps per-job latency and lets small jobs
    share the executors. The first failure is re-raised after all finish,
    so callers keep all-or-nothing semantics. ``ms`` receives wall times.
    """
    def timed(name: str, fn: Callable[[], object]):
        describe(spark, f"{label}: {name}")
        t = time.perf_counter()
        out = fn()
        if ms is not None:
            ms[name] = time.perf_counter() - t
        return out

    if len(jobs) == 1:
        (name, fn), = jobs.items()
        return {name: timed(name, fn)}
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(timed), name, fn)
                   for name, fn in jobs.items()}
        return {name: fut.result() for name, fut in futures.items()}

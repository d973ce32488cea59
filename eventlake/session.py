"""Session construction and the runtime settings the warehouse relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every eventlake job needs, whatever the cluster defaults are.
#  * UTC: EXTRACT / date keys on event_time are computed in the session zone.
#  * duplicate JSON keys keep the last value, as a Python dict does.
#  * static partition overwrite, should a caller overwrite a folder.
#  * the JVM only interprets methods above 8,000 bytes: a wide stage whose fused
#    code has such a method runs as one projection per operator, which is split.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings eventlake depends on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "eventlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with eventlake's settings.

    On a cluster call it without ``master`` and let spark-submit decide; tests
    pass ``local[N]``. The web UI stays off: jobs are observed through
    ``explain()`` and event logs, never through a server.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for derived tables and checkpoints.

    On a cluster this is ``spark.checkpoint.dir`` (or the directory already
    set on the SparkContext), and it is an error if neither is set: executors
    would each write to a disk of their own. Only where the master is local a
    fresh directory is created and registered as the checkpoint dir.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # The context appends a random sub-directory; keep its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
    local = tempfile.mkdtemp(prefix="eventlake-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # a core (non-SQL) setting may be read-only at runtime
        pass
    return local


def describe(spark: SparkSession, text: str) -> None:
    """Label the jobs that follow (event logs / history server show it)."""
    spark.sparkContext.setJobDescription(text)

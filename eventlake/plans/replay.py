"""Replay the event fixture through the whole warehouse, batch by batch.

For each arrival batch: land its JSON lines, ingest them into bronze, run
silver, run gold -- exactly the production sequence, on data Spark derives
from the driver's ``events`` table. Used by the registered queries, the
benchmark and the tests.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.plans.bronze import ingest_batch
from eventlake.plans.gold import apply_seeds, bootstrap, run_gold
from eventlake.plans.pipeline import compact, run_pipeline
from eventlake.plans.silver import run_silver
from eventlake.plans.storage import FileSystem
from eventlake.plans.warehouse import Warehouse
from eventlake.session import configure, scratch_root
from eventlake.sources import fixture as FX
from eventlake.sources.landing import land

_CACHE: dict[tuple[str, str], Warehouse] = {}


def batch_times(batch: int) -> tuple[dt.datetime, dt.datetime, dt.datetime]:
    """(bronze ingest, silver processed_at, gold load) times of a batch."""
    silver = dt.datetime.fromisoformat(FX.processed_at(batch)).replace(tzinfo=dt.timezone.utc)
    return silver - dt.timedelta(minutes=30), silver, silver + dt.timedelta(minutes=30)


def prepared_lines(wh: Warehouse, sf_dir: str) -> DataFrame:
    """The fixture's JSON lines, written once and shared by the four batches."""
    spark, path = wh.spark, wh.path("_prepared/lines")
    lines = FX.envelope(FX.fixture(FX.read_events(spark, sf_dir)))
    lines.write.mode("overwrite").parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def handed(lines: DataFrame, batch: int) -> DataFrame:
    """A batch as the poller passes fetched events on, in memory."""
    return lines.filter(F.col("arrival_batch") == batch).select(
        "value", F.lit("").alias("arrival_file"), F.col("seq").alias("arrival_pos"))


def replay(spark: SparkSession, sf_dir: str, root: str,
           batches=FX.ARRIVAL_BATCHES, stream: bool = False) -> Warehouse:
    """Run the fixture's arrival batches through bronze -> silver -> gold."""
    configure(spark)
    wh = Warehouse(spark, root)
    bootstrap(wh)
    lines = prepared_lines(wh, sf_dir)
    landing = wh.path("landing")
    ingestor = None
    if stream:
        from eventlake.streaming.bronze_stream import BronzeStream
        ingestor = BronzeStream(wh, landing)
    for b in batches:
        ingest_at, silver_at, gold_at = batch_times(b)
        arriving = lines.filter(F.col("arrival_batch") == b)
        if stream:
            # SRC-1: land the batch as JSON-lines files, let the stream pick them up.
            land(spark, arriving, landing, f"b{b:08d}")
            ingestor.run_available(now=ingest_at)
        else:
            ingest_batch(wh, handed(lines, b), batch_id=b, now=ingest_at)
        run_silver(wh, silver_at)
        run_gold(wh, gold_at)
    return wh


def _source_signature(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Identity of a replay: the input table files and the package code."""
    import pathlib

    h = hashlib.sha1(f"{sf_dir}|{kind}".encode())
    for st in FileSystem(spark, sf_dir).list_status(f"{sf_dir.rstrip('/')}/events.parquet"):
        h.update(f"{st[0]}|{st[1]}|{st[2]}".encode())
    pkg = pathlib.Path(__file__).resolve().parents[1]
    for f in sorted(f for f in pkg.rglob("*.py") if "llm" not in f.parts):
        h.update(f.read_bytes())
    return h.hexdigest()[:16]


def replay_edges(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """The hostile lines of the fixture through bronze, silver and gold, in
    two batches that repeat each other's boolean and falsy ids."""
    configure(spark)
    wh = Warehouse(spark, root)
    bootstrap(wh)
    lines = FX.edge_lines(FX.read_events(spark, sf_dir))
    for b in (1, 2):
        ingest_at, silver_at, gold_at = batch_times(b)
        raw = lines.filter(F.col("seq") % 2 == b - 1).select(
            "value", F.lit("").alias("arrival_file"), F.col("seq").alias("arrival_pos"))
        ingest_batch(wh, raw, batch_id=b, now=ingest_at)
        run_silver(wh, silver_at)
        run_gold(wh, gold_at)
    return wh


def replay_etl(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """Bronze batches, with silver and gold run by the stream over commits."""
    from eventlake.streaming.etl_stream import EtlStream

    configure(spark)
    wh = Warehouse(spark, root)
    bootstrap(wh)
    lines = prepared_lines(wh, sf_dir)
    for b in FX.ARRIVAL_BATCHES:
        ingest_at, silver_at, _ = batch_times(b)
        ingest_batch(wh, handed(lines, b), batch_id=b, now=ingest_at)
        EtlStream(wh, clock=lambda: silver_at).run_available()
    return wh


def replay_retried(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """Bronze from a stream whose writer is lost right after every commit: the
    micro-batch fails and is run again."""
    from eventlake.streaming.bronze_stream import BronzeStream

    class Lost(BronzeStream):
        lost = False

        def _ingest(self, batch: DataFrame, epoch_id: int) -> None:
            super()._ingest(batch, epoch_id)
            if not self.lost:
                self.lost = True
                raise RuntimeError("writer lost after its commit")

    configure(spark)
    wh = Warehouse(spark, root)
    lines = prepared_lines(wh, sf_dir)
    for b in FX.ARRIVAL_BATCHES:
        land(spark, lines.filter(F.col("arrival_batch") == b), wh.path("landing"), f"b{b:08d}")
        stream, at = Lost(wh, wh.path("landing")), batch_times(b)[0]
        try:
            stream.run_available(now=at)
        except Exception:
            if not stream.lost:
                raise
            stream.run_available(now=at)
    return wh


def replay_rebuilt(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """All bronze batches; silver and gold are run halfway, dropped, made anew
    in one run and merged; the seeds are applied twice."""
    configure(spark)
    wh = Warehouse(spark, root)
    bootstrap(wh)
    lines = prepared_lines(wh, sf_dir)
    for b in FX.ARRIVAL_BATCHES:
        ingest_batch(wh, handed(lines, b), batch_id=b, now=batch_times(b)[0])
        if b == 2:
            run_pipeline(wh, batch_times(b)[1])
    bootstrap(wh, reset=True)
    last = batch_times(FX.ARRIVAL_BATCHES[-1])
    run_pipeline(wh, last[1], last[2])
    for _ in range(2):
        apply_seeds(wh, last[2])
    compact(wh)
    return wh


BUILDS = {
    "batch": replay, "stream": lambda *args: replay(*args, stream=True), "edges": replay_edges,
    "etl": replay_etl, "retried": replay_retried, "rebuilt": replay_rebuilt,
}


def replayed(spark: SparkSession, sf_dir: str, kind: str = "batch") -> Warehouse:
    """The replayed warehouse of ``sf_dir`` (built once, then reused): its
    ``kind`` is one of ``BUILDS``.

    It lives under the shared scratch folder, keyed by the input files and
    the package source, so later sessions and processes reuse it. A build
    goes to a private directory; a pointer file, written once and never
    replaced, names the finished one, so a failed or concurrent build never
    exposes a partial warehouse.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, f"{sf_dir}|{kind}")
    wh = _CACHE.get(key)
    if wh is not None:
        return wh
    base = f"{scratch_root(spark)}/eventlake-replay"
    pointer = f"{base}/{_source_signature(spark, sf_dir, kind)}.json"
    fs = FileSystem(spark, base)
    if not fs.exists(pointer):
        building = f"{base}/{kind}-{uuid.uuid4().hex}"
        BUILDS[kind](spark, sf_dir, building)
        fs.mkdirs(base)
        tmp = f"{base}/.{uuid.uuid4().hex}.tmp"
        fs.write_text(tmp, json.dumps({"root": building}))
        if not fs.rename(tmp, pointer):
            fs.delete(tmp, False)         # a twin was first; both are whole
    wh = Warehouse(spark, json.loads(fs.read_text(pointer))["root"])
    _CACHE[key] = wh
    return wh

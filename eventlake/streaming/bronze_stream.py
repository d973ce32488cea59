"""STR-1 / STR-3 / STR-4: continuous bronze ingest from a landing folder.

``readStream.text(landing)`` -> ``foreachBatch`` -> ``ingest_batch``. A
micro-batch is named by the query's id, which its checkpoint keeps, and its
epoch; the bronze commit record remembers the last epoch of every stream, so a
micro-batch replayed after a failure is recognised and the ingest is
exactly-once. A new or reset checkpoint is another stream: what it reads again
is deduplicated against every stored batch, with no time horizon, which is why
``dropDuplicatesWithinWatermark`` (it forgets old ids) is not used.
"""

from __future__ import annotations

import datetime as dt
import json
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.plans.bronze import ingest_batch
from eventlake.plans.warehouse import Warehouse

#: Reports a long-running stream keeps in memory; all are in bronze/batch_reports.
KEPT_REPORTS = 1000


def finish(query: StreamingQuery, timeout_s: float | None) -> None:
    """Wait for an ``availableNow`` query; a limit is the caller's choice."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the stream did not finish within {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


class BronzeStream:
    """``glob`` limits the files taken by name; by default all landed files
    are, compressed ones included."""

    def __init__(self, wh: Warehouse, landing: str, checkpoint: str | None = None,
                 max_files_per_trigger: int | None = None, glob: str | None = None):
        self.wh = wh
        self.landing = landing
        self.checkpoint = checkpoint or wh.path("_checkpoints/bronze_stream")
        self.max_files = max_files_per_trigger
        self.glob = glob
        self.now: dt.datetime | None = None
        self.reports: deque[dict] = deque(maxlen=KEPT_REPORTS)

    def _source(self) -> DataFrame:
        reader = self.wh.spark.readStream.format("text")
        if self.glob:
            reader = reader.option("pathGlobFilter", self.glob)
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", str(self.max_files))
        return reader.load(self.landing).select(
            "value", F.col("_metadata.file_path").alias("arrival_file"))

    def _stream_id(self) -> str:
        """The query's id, as Spark keeps it in the checkpoint."""
        return json.loads(self.wh.fs.read_text(f"{self.checkpoint}/metadata"))["id"]

    def _ingest(self, batch: DataFrame, epoch_id: int) -> None:
        # The position is taken on the micro-batch's own scan, before any shuffle.
        raw = batch.withColumn("arrival_pos", F.monotonically_increasing_id())
        self.reports.append(ingest_batch(self.wh, raw, now=self.now, stream=(self._stream_id(), epoch_id)))

    def start(self, processing_time: str = "60 seconds") -> StreamingQuery:
        """Run continuously with a fixed trigger interval."""
        return (self._source().writeStream.foreachBatch(self._ingest)
                .option("checkpointLocation", self.checkpoint)
                .trigger(processingTime=processing_time).start())

    def run_available(self, now: dt.datetime | None = None, timeout_s: float | None = None) -> list[dict]:
        """Ingest everything landed so far, then stop (``availableNow``);
        returns the reports of this call, the newest ``KEPT_REPORTS`` at most."""
        self.now = now
        self.reports.clear()
        finish(self._source().writeStream.foreachBatch(self._ingest)
               .option("checkpointLocation", self.checkpoint)
               .trigger(availableNow=True).start(), timeout_s)
        return list(self.reports)

"""Helpers shared by the operators: table reads, tables in the shared folder,
and appending one computed struct column to every row through Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventlake.session import scratch_root

#: Rows of one Arrow batch handed to Python. Bounds a worker's memory to this
#: many texts; a single text is always whole.
ARROW_ROWS = 512
#: And to about this many bytes, where the rows are long.
ARROW_BYTES = 32 << 20

LOWER_AZ = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, wherever they run: a zip on
    the driver, which Spark hands to the executors."""
    context = spark.sparkContext
    if getattr(context, "_eventlake_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="eventlake-code-")) / "eventlake_code.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted((root / "eventlake").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(str(target))
    context._eventlake_shipped = True


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small Arrow batches (documents can be long)."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def materialise(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder, with a folder for each
    value of ``by``, and read it back.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, so a
    lost executor costs a re-read, not a recomputation, and every consumer
    sees the same rows.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system, where the C library can: a worker
    that has done a stage waits idle beside the tasks of the next ones."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def joined(batches: Iterator[pa.RecordBatch], at: int, least: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until column ``at`` has ``least`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.column(at).nbytes for b in held) >= least:
            yield pa.concat_batches(held) if len(held) > 1 else batch
            held = []
    if held:
        yield pa.concat_batches(held)


def append_struct(
    df: DataFrame,
    out: str,
    fields: T.StructType,
    kernel: Callable[[list[str | None]], dict[str, list]],
    text_col: str = "text",
    setup: Callable[[], object] | None = None,
    gather: int = 0,
) -> DataFrame:
    """``df`` with one more column ``out``: a struct computed from ``text_col``.

    ``kernel(texts)`` (or ``kernel(state, texts)`` with ``setup``, run once per
    task) returns a list per field. Every other column passes through
    untouched, whatever its name; a column already called ``out`` is replaced.
    ``gather`` joins batches until their texts have so many bytes, for kernels
    with a cost per call.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(df.sparkSession)
    kept = df.drop(out) if out in df.columns else df
    schema = T.StructType([*kept.schema.fields, T.StructField(out, fields)])
    arrow = to_arrow_schema(fields)
    at = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in joined(batches, at, gather):
            texts = batch.column(at).to_pylist()
            values = kernel(state, texts) if setup else kernel(texts)
            struct = pa.StructArray.from_arrays(
                [pa.array(values[f.name], f.type) for f in arrow], fields=list(arrow)
            )
            names = [*batch.schema.names, out]
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=names)
        state = None
        give_back()

    return kept.mapInArrow(run, schema)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or with underscores before it, so that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish

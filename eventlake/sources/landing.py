"""SRC-1 / SRC-2: raw event text with a stable arrival order.

Landed files hold one JSON envelope per line; file names sort in arrival
order (the poller names them by time). The arrival order of a line is
``(arrival_file, arrival_pos)``: the file path, then the line's position
taken straight off the scan, before any shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.plans.storage import FileSystem
from eventlake.session import scratch_root

ARRIVAL = ("arrival_file", "arrival_pos")


def with_arrival(lines: DataFrame) -> DataFrame:
    """Add the arrival order to a text scan (must be applied on the scan)."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("arrival_file"),
        F.monotonically_increasing_id().alias("arrival_pos"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of JSON-lines files (a file, directory or glob)."""
    return with_arrival(spark.read.text(path))


def read_json_arrays(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: files that each hold one JSON array of envelopes, one row per
    element, in document order, however large a file is.

    A file is cut at every closing brace, which Spark's text reader does in
    parallel for the splits of a file. Whether a brace ends an element depends
    on what is before it: a quote opened, brackets and braces open. A piece of
    text changes that state in a way that can be told for both starts, inside a
    string and outside, so it is summed up per piece, then per split, the splits
    are put in order (a row each), and every piece gets its state: a prefix
    scan. Pieces up to a brace that leaves one bracket open are one element.

    ``arrival_pos`` numbers the objects of an array; an element that is no
    object stands with the object after it. A file that is no array comes out
    as a single line, and so does a damaged element or the rest of a file that
    is cut off inside an element: ``classify`` rejects them. An empty file gives
    nothing.
    """
    pieces = _pieces(spark, path)
    summary = f"{scratch_root(spark)}/eventlake-arrays/{uuid.uuid4().hex}"
    _states(pieces).select(*_SPLIT, "pos", "quotes", "before", "depth0", "depth1", "is_array", "file_size", "size").write.parquet(summary)
    known = spark.read.parquet(summary)
    # Per split: its effect, and from the splits before it the state it starts in.
    last = F.struct("pos", ((F.col("before") + F.col("quotes")) % 2).alias("parity"), "depth0", "depth1")
    splits = known.groupBy(*_SPLIT).agg(
        F.max(last).alias("all"), F.min(F.struct("pos", "is_array")).alias("begin"), F.sum("size").alias("bytes"),
        F.first("file_size").alias("file_size")).select(*_SPLIT, "all.*", "begin.is_array", "bytes", "file_size")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy("file")
    splits = splits.withColumn("start", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    splits = splits.select(
        *_SPLIT, "start", F.coalesce(F.sum(F.when(F.col("start") == 0, F.col("depth0")).otherwise(F.col("depth1"))).over(earlier), F.lit(0)).alias("open"),
        F.first("is_array").over(of_file.orderBy("split")).alias("array"),
        # Every piece but the last ends in a brace; the file's size tells whether that does.
        (F.sum("bytes").over(of_file) == F.col("file_size")).alias("closed"), F.max("pos").over(of_file).alias("last"))
    counts = _ends(known.join(splits, list(_SPLIT))).groupBy(*_SPLIT).agg(F.sum("ends").alias("ended"))
    starts = splits.join(counts, list(_SPLIT)).select(
        *splits.columns, F.coalesce(F.sum("ended").over(earlier), F.lit(0)).alias("earlier"), F.sum("ended").over(of_file).alias("total"))
    # The text goes to its split's task, and from there to its element's.
    in_split = Window.partitionBy(*_SPLIT).orderBy("pos")
    numbered = _ends(_states(pieces).drop("is_array", "file_size").join(starts, list(_SPLIT))).withColumn(
        "element", F.col("earlier") + F.sum("ends").over(in_split) - F.col("ends"))
    part = F.struct("split", "pos", F.concat("value", F.lit("}")).alias("text"))
    # By number: parsing costs more than the bytes tell, which would be coalesced.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = numbered.repartition(tasks, "file", "element").groupBy("file", "element", "total", "array", "closed").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(part)), lambda x: x["text"])).alias("text"))
    is_last = F.col("element") == F.col("total")
    text = F.when(is_last & ~F.col("closed"), F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    body = F.regexp_replace("line", r"\A\s*[\[,]", "")
    body = F.when(is_last, F.regexp_replace(body, r"\]\s*\z", "")).otherwise(body)
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))), "$", "array<variant>")
    closes = ~is_last | F.col("line").rlike(r"\]\s*\z")  # else the file is cut off
    items = F.when(F.col("array") & closes & listed.isNotNull(), F.transform(listed, lambda x: F.to_json(x))).otherwise(F.array("line"))
    return joined.withColumn("line", text).select(
        F.explode(items).alias("value"), F.col("file").alias("arrival_file"), F.col("element").cast("bigint").alias("arrival_pos"))


_SPLIT = ("file", "split")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces, with its file, split and place."""
    return spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("pos"))


def _states(pieces: DataFrame) -> DataFrame:
    """What each piece, with the brace after it, does to the state, and what
    the pieces of its split before it do: ``quotes`` (parity of quotes),
    ``before`` (of those before), and the brackets that are open after it if the
    split starts outside a string (``depth0``) or inside (``depth1``)."""
    # An escape never reaches over a closing brace. Between quotes, text is
    # outside and inside a string in turn.
    plain = F.when(F.instr("value", "\\") > 0, F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    parts = pieces.withColumn("parts", F.split(plain, '"', -1))
    every = lambda odd: F.concat_ws("", F.filter("parts", lambda x, i: i % 2 == odd))
    # Texts of their own columns, so that each is made once and counted often.
    parts = parts.withColumns({"text0": every(0), "text1": every(1)})
    count = lambda odd, chars: F.length(f"text{odd}") - F.length(F.translate(f"text{odd}", chars, ""))
    net = lambda odd: count(odd, "{[") - count(odd, "]")
    quotes = parts.withColumn("quotes", (F.size("parts") - 1) % 2).select(
        *pieces.columns, "quotes",
        # The brace counts if the piece ends outside a string.
        (net(0) - F.when(F.col("quotes") == 0, 1).otherwise(0)).alias("net0"),
        (net(1) - F.when(F.col("quotes") == 1, 1).otherwise(0)).alias("net1"),
        (F.octet_length("value") + 1).alias("size"), F.startswith(F.ltrim(F.regexp_replace("value", r"\A\s+", "")), F.lit("[")).alias("is_array"))
    upto = Window.partitionBy(*_SPLIT).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = quotes.withColumn("before", (F.sum("quotes").over(upto) - F.col("quotes")) % 2)
    even = F.col("before") == 0
    return begun.withColumns({
        "depth0": F.sum(F.when(even, F.col("net0")).otherwise(F.col("net1"))).over(upto),
        "depth1": F.sum(F.when(even, F.col("net1")).otherwise(F.col("net0"))).over(upto)}).drop("net0", "net1")


def _ends(states: DataFrame) -> DataFrame:
    """``ends``: 1 where the brace after a piece ends an element of the array."""
    depth = F.col("open") + F.when(F.col("start") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    outside = (F.col("start") + F.col("before") + F.col("quotes")) % 2 == 0
    brace = F.col("closed") | (F.col("pos") != F.col("last"))
    return states.withColumn("ends", (F.col("array") & outside & brace & (depth == 1)).cast("long"))


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """The same for many small files: each is read whole by one task. A file
    that is not a valid array comes out as a single line."""
    docs = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("arrival_file"))
    arr = F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")
    items = F.when(arr.isNull(), F.array(F.col("value"))).otherwise(
        F.transform(arr, lambda x: F.to_json(x)))
    return docs.select("arrival_file", F.posexplode(items).alias("arrival_pos", "value")).select(
        "value", "arrival_file", F.col("arrival_pos").cast("bigint"))


def land(spark: SparkSession, lines: DataFrame, landing_dir: str, prefix: str,
         order_col: str = "seq") -> list[str]:
    """Write ``lines.value`` as JSON-lines files into ``landing_dir``.

    Lines are range-ordered by ``order_col`` and each part is moved into the
    landing folder under ``<prefix>-<part>.jsonl`` with one rename, so a file
    stream never sees a half-written file and names sort in arrival order.
    """
    fs = FileSystem(spark, landing_dir)
    staging = f"{landing_dir.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    lines.orderBy(order_col).select("value").write.text(staging)
    fs.mkdirs(landing_dir)
    landed = []
    for name in fs.list_names(staging):
        if not name.startswith("part-"):
            continue
        target = f"{landing_dir.rstrip('/')}/{prefix}-{name.split('.')[0]}.jsonl"
        if not fs.rename(f"{staging}/{name}", target):
            raise RuntimeError(f"could not land {name} as {target}")
        landed.append(target)
    fs.delete(staging)
    return landed

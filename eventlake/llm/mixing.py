"""Mixing sources to target weights, with DataFrame functions only.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating; the
mix is as large as the corpus; a target stops at ``max_repeats`` times its
source's words and the excess is shared again by weight until none is above.

Tokens here are words. Per source, documents are laid end to end in a
pseudorandom order and cut into blocks of ``block`` words (the last may be
shorter). The mix is a list of slots, each holding one block: a source's slots
are full rounds over its blocks and one partial round, whose last slot takes
only part of its block so that the words taken meet the target. The block of
slot i in round r is the image of i under that source's and round's
pseudorandom index permutation (swap-or-not: exact on any number of blocks, no
sorting). The place of a slot in the output is its image under one permutation
of all slots, and shards are cut from places. So the counts of sources in the
shards are a multinomial draw conditioned on the totals; drawn freely, a
source of k slots would miss its target by about sqrt(k) slots. Slots and
documents are joined on (source, block).

Skew: no step gathers a source. Offsets are sums over ranges of the order's
hash, first per (source, range), then inside it; ranges are sized by the row
count and don't change the result. Slots are made from chunks of
``CHUNK_SLOTS``. Only per-source totals meet in one task, one row a source.

Null and blank texts have size 0 and are never taken. Repeated rows are
documents of their own; equal rows may swap places with each other. An empty
table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import materialise, table

SIZE_PATTERN = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK = 128
SHARD_SLOTS = 8192
CHUNK_SLOTS = 4096
TASK_SLOTS = 65_536
RANGE_ROWS = 4096
ROUNDS = 24
SEED = 20_240
SPOTS = 1 << 40


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """The image of x (0 <= x < n) under the swap-or-not permutation of
    ``key``: every round swaps x with k - x mod n, or not, by a hash of the
    larger of the two."""

    def swap(value: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), r, *key), n) - value, n)
        high = F.greatest(value, other)
        return F.when(F.xxhash64(r, high, F.lit(SEED), *key).bitwiseAND(F.lit(1)) == 1, other).otherwise(value)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, swap)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sizes(source, source_size)`` with the source's rank and target.

    Filling by weight with a ceiling: in order of ceiling / weight, the
    sources up to some point stop at their ceiling and the rest share what is
    left; a source is stopped if its ceiling is below its share of what the
    earlier ones leave.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("source_no", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    ceiling = F.col("source_size") * max_repeats
    ordered = Window.orderBy("ratio", "source_no")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ranked.withColumn("weight", weight).withColumn("ceiling", ceiling).withColumn("ratio", F.col("ceiling") / F.col("weight"))
    level = level.withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
    level = level.withColumn("share", (F.col("total") - F.coalesce(F.sum("ceiling").over(before), F.lit(0)))
                             / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    level = level.withColumn("stopped", F.col("ratio") <= F.col("share"))
    first = F.min(F.when(~F.col("stopped"), F.struct("ratio", "source_no", "share"))).over(everything)
    target = F.when(F.col("stopped"), F.col("ceiling").cast("double")).otherwise(F.col("weight") * first["share"])
    return level.withColumn("target", target).select("source", "source_no", "source_size", "target")


class Mix:
    """The parts of a mix, all of them DataFrames.

    ``documents``: the rows given, with size, source_no, source_size, target
    and ``start``, the offset in the source. ``slots``: shard, place,
    source_no, source_slot, round, block, take (words from the block's
    start). ``pieces``: source_no, start, round, lo, hi: the words of a
    document that a round takes, counted inside the document.
    """

    def __init__(self, df: DataFrame, source_col: str = "source", text_col: str = "text", keep: list[str] | None = None,
                 key_col: str = "doc_id", block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS,
                 max_repeats: int = MAX_REPEATS, shard_slots: int = SHARD_SLOTS):
        self.block, self.shard_slots = block, shard_slots
        size = F.when(F.col(text_col).isNull(), 0).otherwise(F.regexp_count(F.col(text_col), F.lit(SIZE_PATTERN))).cast("long")
        # The rows themselves travel in one struct, so their names can't clash with the columns made here.
        row = F.struct(*(F.col(c) for c in (keep or df.columns)))
        h = F.xxhash64(F.lit(SEED), F.col(key_col), F.col(text_col))
        sized = df.select(row.alias("row"), F.col(source_col).alias("source"), size.alias("size"), h.alias("h"))
        sized = sized.withColumn("spot", F.pmod("h", F.lit(SPOTS)))
        counted = materialise(sized.select("source", "size", "spot"), "mix-sizes")
        ranges = max(1, -(-counted.count() // RANGE_ROWS))
        which = F.floor(F.col("spot") / F.lit(SPOTS // ranges)).cast("long")
        totals = counted.groupBy("source", which.alias("range")).agg(F.sum("size").alias("words"))
        of_source = totals.groupBy("source").agg(F.sum("words").alias("source_size"))
        self.sources = materialise(source_targets(of_source, weights, max_repeats), "mix-sources")
        earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
        totals = totals.join(self.sources, F.col("source").eqNullSafe(F.col("s"))).drop("source")
        inside = Window.partitionBy("source", "range").orderBy("spot", "h", "row." + key_col, "size").rowsBetween(Window.unboundedPreceding, -1)
        laid = sized.withColumn("range", which).withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        laid = laid.join(totals, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
        laid = laid.select("row", "size", "source_no", "source_size", "target", (F.col("before") + F.col("within")).alias("start"))
        self.documents = materialise(laid, "mix-laid")
        self.slots = self._slots()
        self.pieces = self._pieces()

    def _slots(self) -> DataFrame:
        size, block = F.col("source_size"), self.block
        per_source = self.sources.where("source_size > 0").withColumn("words", F.round("target").cast("long"))
        per_source = per_source.withColumn("n_blocks", F.ceil(size / block).cast("long"))
        per_source = per_source.withColumn("rounds", F.floor(F.col("words") / size).cast("long"))
        per_source = per_source.withColumn("rest", F.col("words") - F.col("rounds") * size)
        per_source = per_source.withColumn("n_slots", F.col("rounds") * F.col("n_blocks") + F.ceil(F.col("rest") / block).cast("long"))
        every = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
        per_source = per_source.withColumn("first_slot", F.coalesce(F.sum("n_slots").over(every), F.lit(0)))
        per_source = per_source.withColumn("all_slots", F.sum("n_slots").over(Window.partitionBy()))
        chunks = per_source.where("n_slots > 0").withColumn(
            "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / CHUNK_SLOTS).cast("long"))))
        # By number: a chunk is a few bytes and 4096 slots, so sizes in bytes say nothing of the work.
        slots = self.sources.agg(F.sum("target")).first()[0] or 0
        chunks = chunks.repartition(max(1, -(-int(slots) // (block * TASK_SLOTS))), "source_no", "chunk")
        first = F.col("chunk") * CHUNK_SLOTS
        last = F.least(first + CHUNK_SLOTS, F.col("n_slots")) - 1
        slots = chunks.withColumn("source_slot", F.explode(F.sequence(first, last)))
        slots = slots.withColumn("round", F.floor(F.col("source_slot") / F.col("n_blocks")).cast("long"))
        index = F.col("source_slot") - F.col("round") * F.col("n_blocks")
        partial, n_full = F.col("round") >= F.col("rounds"), F.floor(size / block).cast("long")
        domain = F.when(partial, F.greatest(n_full, F.lit(1).cast("long"))).otherwise(F.col("n_blocks"))
        mixed = permuted(index, domain, F.col("source_no"), F.col("round"))
        slots = slots.withColumn("block", F.when(partial & (index == n_full), n_full).otherwise(mixed))
        left = F.when(partial, F.col("rest") - index * block).otherwise(F.lit(block))
        slots = slots.withColumn("take", F.least(left.cast("long"), F.lit(block).cast("long"), size - F.col("block") * block))
        place = permuted(F.col("first_slot") + F.col("source_slot"), F.col("all_slots"), F.lit(-1))
        slots = slots.withColumn("slot_place", place)
        return slots.select(
            F.floor(F.col("slot_place") / self.shard_slots).cast("long").alias("shard"),
            (F.col("slot_place") % self.shard_slots).alias("place"), "source_no", "source_slot", "round", "block", "take")

    def _pieces(self) -> DataFrame:
        block = self.block
        spread = self.documents.where("size > 0").select("source_no", "start", "size", F.explode(F.sequence(
            F.floor(F.col("start") / block).cast("long"), F.floor((F.col("start") + F.col("size") - 1) / block).cast("long"))).alias("block"))
        # The planner can't see how many slots a source has and would broadcast them all.
        slots = self.slots.select("source_no", "block", "round", "take").hint("merge")
        joined = spread.join(slots, ["source_no", "block"])
        base = F.col("block") * block - F.col("start")
        lo, hi = F.greatest(base, F.lit(0).cast("long")), F.least(base + F.col("take"), F.col("size"))
        return joined.select("source_no", "start", "round", lo.alias("lo"), hi.alias("hi")).where("hi > lo")

    def taken(self) -> DataFrame:
        """``documents`` with the number of words taken from each."""
        sums = self.pieces.groupBy(F.col("source_no").alias("n"), F.col("start").alias("s")).agg(F.sum(F.col("hi") - F.col("lo")).alias("words"))
        joined = self.documents.join(
            sums, (F.col("source_no") == F.col("n")) & (F.col("start") == F.col("s")) & (F.col("size") > 0), "left")
        return joined.withColumn("taken", F.coalesce("words", F.lit(0).cast("long"))).drop("n", "s", "words")

    def texts(self, text_col: str = "text") -> DataFrame:
        """The mixed corpus: a row for every document and round that takes any
        of its words, with the words taken (and the white space before them)
        as its text. A document taken whole keeps its text untouched."""
        ranges = self.pieces.groupBy(F.col("source_no").alias("n"), F.col("start").alias("s"), "round").agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("ranges"), F.sum(F.col("hi") - F.col("lo")).alias("words"))
        rows = self.documents.where("size > 0").join(ranges, (F.col("source_no") == F.col("n")) & (F.col("start") == F.col("s")))
        tokens = F.regexp_extract_all(F.col("row." + text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
        # The words are a lambda's argument, so that they are cut once a row and not once a range.
        cut = F.transform(F.array(tokens), lambda words: F.ltrim(F.concat_ws("", F.flatten(F.transform(
            "ranges", lambda r: F.slice(words, (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")))))))[0]
        text = F.when(F.col("words") == F.col("size"), F.col("row." + text_col)).otherwise(cut)
        return rows.select("row", "round", text.alias("mixed_text"))


def op4_mixing(spark, sf_dir):
    """Contract query: size, target and words taken of every document."""
    mix = Mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mix.taken().select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")

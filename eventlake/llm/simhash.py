"""SimHash near-dedup with a pigeonring filter.

Fingerprints: lower-cased (A-Z) words, word shingles with repeats, XXH64 with
seed 42 of each shingle; bit *b* is set when more than half of the hashes have
it. Texts without a word (null, empty, blank) have fingerprint 0 and are
linked like any other.

Links: two distinct fingerprints link when at most ``max_distance`` (d) bits
differ. The 64 bits are cut into a ring of m = 2d + 1 segments. By the
pigeonring principle any pair within d bits has a start from which every chain
of the first l segments differs in at most floor(l * d / m) bits. So the first
two segments agree, and of the next two at least one agrees: each fingerprint
is filed under those keys (10 keys of 38-39 bits for d = 2), only fingerprints
under one key meet, chains over their budget are pruned, and the full Hamming
distance decides.

Skew: exact copies collapse into one fingerprint before anything is paired. A
key with more than ``RUN_LIMIT`` distinct fingerprints is not paired in one
task: its members are filed again under finer keys cut from the bits that the
key leaves free, until the free bits bound the run. A run emits a spanning set
of its links, never all its pairs, and components are found by alternating
large-star / small-star rounds over written tables. The edges of a star's
centre and the rows of one fingerprint are joined by (key, slice).

Null ids are kept and lose against any other id as the class id; repeated rows
each get their row back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import LOWER_AZ, give_back, materialise, small_batches

#: Largest number of distinct fingerprints compared with each other in one run.
RUN_LIMIT = 2048
#: Edges a task contracts at a time before the star rounds.
EDGE_CHUNK = 500_000
#: Tasks over which the edges of one centre, and the rows of one fingerprint, are dealt.
SLICES = 64
#: Shingles hashed at a time, so that memory doesn't grow with a text.
SHINGLE_CHUNK = 65_536


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a whole text."""
    words = (text or "").encode().translate(LOWER_AZ).split()
    if not words:
        return 0
    ones = np.zeros(64, np.int64)
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLE_CHUNK):
        part = words[at : min(n, at + SHINGLE_CHUNK) + shingle - 1]
        shingles = zip(*(part[i:] for i in range(shingle))) if len(part) >= shingle else [part]
        hashes = np.array([digest(b" ".join(s), 42) for s in shingles], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed 64-bit number."""
    small_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])
        give_back()

    return rows.mapInArrow(run, schema)


def ring(free: int, m: int) -> list[int]:
    """Cut the set bits of ``free`` into m segments of nearly equal length."""
    bits = [b for b in range(64) if free >> b & 1]
    edges = [round(i * len(bits) / m) for i in range(m + 1)]
    return [sum(1 << b for b in bits[edges[i] : edges[i + 1]]) for i in range(m)]


def key_masks(fixed: int, d: int) -> dict[int, list[int]]:
    """Key mask -> the ring's segments from the start that the mask stands for.

    ``fixed`` are the bits on which the fingerprints already agree.
    """
    m = 2 * d + 1
    segments = ring(~fixed & (1 << 64) - 1, m)
    out: dict[int, list[int]] = {}
    for start in range(m):
        chain = segments[start:] + segments[:start]
        if d < 2:
            out.setdefault(fixed | sum(chain[: 2 * d]), chain)  # d = 0: no free segment is needed
            continue
        for third in (2, 3):
            out.setdefault(fixed | chain[0] | chain[1] | chain[third], chain)
    if d == 0:
        return {(1 << 64) - 1: segments}
    return out


def linked(x: np.ndarray, chain: list[int], d: int) -> np.ndarray:
    """Positions of the differences ``x`` that pass every chain and the full check."""
    at, total, m = np.arange(len(x)), np.zeros(len(x), np.int64), len(chain)
    for length, segment in enumerate(chain, 1):
        total = total + np.bitwise_count(x[at] & np.uint64(segment))
        keep = total <= length * d // m
        at, total = at[keep], total[keep]
    return at[np.bitwise_count(x[at]) <= d]


def run_links(fps: np.ndarray, chain: list[int], d: int) -> list[tuple[int, int]]:
    """A spanning set of the links among the fingerprints of one key."""
    label, out = np.arange(len(fps)), []
    for i in range(len(fps) - 1):
        hits = i + 1 + linked(fps[i] ^ fps[i + 1 :], chain, d)
        for j in hits[label[hits] != label[i]]:
            if label[j] != label[i]:
                out.append((i, int(j)))
                label[label == label[j]] = label[i]
    return out


LINK_SCHEMA = "a long, b long, mask long, fp long"


def pair_runs(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """Links of runs of equal (mask, key) in sorted rows; rows of a run over
    the limit come back with the finer masks they are to be filed under."""
    chains: dict[int, list[int]] = {}
    finer: dict[int, list[int]] = {}

    def chain_of(mask: int) -> list[int]:
        if mask not in chains:
            raise KeyError(f"unknown key mask {mask:x}")
        return chains[mask]

    def learn(fixed: int, depth: int) -> None:
        for mask, chain in key_masks(fixed, d).items():
            if mask not in chains:
                chains[mask] = chain
                if depth:
                    learn(mask, depth - 1)
            finer.setdefault(fixed, []).append(mask)

    learn(0, 2 if d else 0)
    links: list[tuple[int, int]] = []
    later: list[tuple[int, int]] = []

    def flush() -> pa.RecordBatch:
        a, b = (np.array([x[i] for x in links], np.uint64).view(np.int64) for i in (0, 1))
        mask, fp = (np.array([x[i] for x in later], np.uint64).view(np.int64) for i in (0, 1))
        n, k = len(a), len(fp)
        none = lambda size: pa.nulls(size, pa.int64())
        cols = [pa.concat_arrays(p) for p in (
            [pa.array(a), none(k)], [pa.array(b), none(k)], [none(n), pa.array(mask)], [none(n), pa.array(fp)])]
        links.clear()
        later.clear()
        return pa.RecordBatch.from_arrays(cols, names=["a", "b", "mask", "fp"])

    def close(mask: int, fps: np.ndarray) -> None:
        if len(fps) > RUN_LIMIT and mask in finer:
            later.extend((m, int(f)) for m in finer[mask] for f in fps)
        elif len(fps) > 1:
            links.extend((int(fps[i]), int(fps[j])) for i, j in run_links(fps, chain_of(mask), d))

    held_mask, held = None, np.zeros(0, np.uint64)
    over = False  # the held run is over the limit: its rows go on as they come
    for batch in batches:
        masks = batch.column(0).to_numpy().view(np.uint64)
        fps = batch.column(2).to_numpy().view(np.uint64)
        keys = fps & masks
        cuts = np.flatnonzero((masks[1:] != masks[:-1]) | (keys[1:] != keys[:-1])) + 1
        edges = [0, *cuts.tolist(), len(fps)]
        for lo, hi in zip(edges, edges[1:]):
            if lo == hi:
                continue
            mask, part = int(masks[lo]), fps[lo:hi]
            same = held_mask == mask and len(held) and (int(held[0]) & mask) == (int(part[0]) & mask)
            if not same:
                if len(held) and not over:
                    close(held_mask, held)
                held_mask, held, over = mask, part, False
            elif over:
                later.extend((m, int(f)) for m in finer[mask] for f in part)
            else:
                held = np.concatenate([held, part])
            if not over and len(held) > RUN_LIMIT and mask in finer:
                close(mask, held)
                held, over = held[:1], True
        if links or later:
            yield flush()
    if len(held) and not over:
        close(held_mask, held)
    if links or later:
        yield flush()


def find_links(fps: DataFrame, d: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fps(fp)`` that connect
    every pair within d bits."""
    small = fps.sparkSession
    signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    masks = F.array(*(F.lit(signed(m)).cast("long") for m in key_masks(0, d)))
    rows = fps.select(F.explode(masks).alias("mask"), "fp")
    found = None
    while True:
        filed = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        filed = filed.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        small.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "65536")
        out = materialise(filed.mapInArrow(lambda b: pair_runs(b, d), LINK_SCHEMA), "simhash-links")
        small_batches(small)
        links = out.where("a is not null").select("a", "b")
        found = links if found is None else found.unionByName(links)
        rows = out.where("fp is not null").select("mask", "fp").distinct()
        if out.where("fp is not null").isEmpty():
            return found


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a task, a bounded chunk at a time, by stars."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def stars() -> pa.RecordBatch:
        pairs = [(x, find(x)) for x in parent]
        pairs = [(u, v) for u, v in pairs if u != v]
        parent.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = find(u), find(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
        if len(parent) > EDGE_CHUNK:
            yield stars()
    if parent:
        yield stars()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``: the smallest number
    reachable, by alternating large-star and small-star rounds."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialise(edges.mapInArrow(contract, "u long, v long").distinct(), "simhash-edges")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both, "u", "v").withColumn("m", F.least("u", "m"))
        large = large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = with_least(large, "u", "v").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialise(small.where("u <> v").distinct(), "simhash-edges")


def sliced(rows: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` with ``slice``: the rows of one key dealt over ``SLICES``."""
    return rows.withColumn("slice", F.pmod(F.xxhash64(by), F.lit(SLICES)))


def with_least(edges: DataFrame, key: str, value: str) -> DataFrame:
    """``edges`` with ``m``, the least ``value`` of their ``key``: taken per
    slice, then per key, and joined back by (key, slice), so that the many
    edges of one centre never meet in a task."""
    dealt = sliced(edges, key, value)
    per_slice = dealt.groupBy(key, "slice").agg(F.min(value).alias("m"))
    per_key = per_slice.groupBy(F.col(key).alias("k")).agg(F.min("m").alias("least"))
    least = per_slice.join(per_key, F.col(key) == F.col("k")).select(key, "slice", F.col("least").alias("m"))
    return dealt.join(least, [key, "slice"]).drop("slice")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """(id, fp, component): for every row its fingerprint and the smallest id
    reachable over links. The id may be of any orderable type."""
    if not 0 <= max_distance <= 3:
        raise ValueError("max_distance must be from 0 to 3: beyond that the keys get too short to prune")
    rows = materialise(fingerprints(df, id_col, text_col, shingle), "simhash-fps")
    per_fp = materialise(rows.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-distinct")
    roots = components(find_links(per_fp.select("fp"), max_distance))
    inside = per_fp.join(roots, per_fp.fp == roots.node).select("fp", "root", "least_id")
    least = inside.groupBy("root").agg(F.min("least_id").alias("component"))
    of_fp = inside.join(least, "root").select(F.col("fp").alias("linked_fp"), "component")
    per_fp = per_fp.join(of_fp, F.col("fp") == F.col("linked_fp"), "left").select(
        "fp", F.coalesce("component", "least_id").alias("component"))
    # Exact copies have one fingerprint: their rows are joined slice by slice.
    dealt = sliced(rows, "fp", "id")
    classes = dealt.select(F.col("fp").alias("f"), F.col("slice").alias("s")).distinct().join(
        per_fp.withColumnRenamed("fp", "of"), F.col("f") == F.col("of")).select("f", "s", "component")
    return dealt.join(classes, (F.col("fp") == F.col("f")) & (F.col("slice") == F.col("s"))).select("id", "fp", "component")


def op5_simhash(spark, sf_dir):
    """Contract query: component of every document at 3-word shingles, 2 bits."""
    from eventlake.llm.common import table

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))

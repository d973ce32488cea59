import collections
import random
import re
import struct

import xxhash
from llm_rows import LONG, clash, docs
from pyspark.sql import functions as F

from eventlake.llm import mixing as M


def spark_hash(*values):
    """Spark's xxhash64 of longs and ints (int as 4 bytes, long as 8)."""
    seed = 42
    for kind, v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<i" if kind == "i" else "<q", v), seed & (1 << 64) - 1)
    return seed - (1 << 64) if seed >> 63 else seed


def brute_permuted(x, n, key):
    for r in range(1, M.ROUNDS + 1):
        k = spark_hash(("i", M.SEED), ("i", r), *key) % n
        other = (k - x) % n
        if spark_hash(("i", r), ("q", max(x, other)), ("i", M.SEED), *key) & 1:
            x = other
    return x


def brute_targets(sizes):
    """Share by weight again and again until nothing is above its ceiling."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weight = {n: M.WEIGHTS[i % 3] for i, n in enumerate(names)}
    target, left, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        total = sum(weight[n] for n in open_)
        over = {n for n in open_ if left * weight[n] / total >= 3 * sizes[n]}
        if not over:
            return target | {n: left * weight[n] / total for n in open_}
        for n in over:
            target[n] = 3 * sizes[n]
            left -= 3 * sizes[n]
        open_ -= over
    return target


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(n=300, seed=1):
    rnd = random.Random(seed)
    sources = ["a", "B", "é", "", None, "src10", "src2", "\U0001f600"]
    return [(i, " \n".join(f"w{rnd.randint(0, 99)}" for _ in range(rnd.choice([0, 1, 5, 40, 700]))),
             "en", sources[min(7, int(rnd.expovariate(0.6)))]) for i in range(n)] + [(n, None, "en", "a"), (n + 1, LONG, "en", "a")]


def test_permutation_is_exact(spark):
    for n in (1, 2, 3, 17, 1000):
        rows = spark.range(n).select(M.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(4), F.lit(2).cast("long")).alias("y")).collect()
        got = [r["y"] for r in rows]
        assert sorted(got) == list(range(n))
        assert got == [brute_permuted(x, n, (("i", 4), ("q", 2))) for x in range(n)]


def test_targets_and_words_taken(spark):
    rows = corpus()
    mix = M.Mix(clash(docs(spark, rows), "size", "taken", "start", "row", "range", "s"))
    got = mix.taken().select("row.doc_id", F.col("row.source").alias("src"), "size", "source_size", "target", "taken").collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want, taken = brute_targets(dict(sizes)), collections.Counter()
    for r in got:
        assert r["size"] == len(words(text[r["doc_id"]])) and r["source_size"] == sizes[r["src"]]
        assert abs(r["target"] - want[r["src"]]) <= 1e-6 * max(1, want[r["src"]])
        assert r["taken"] <= 3 * r["size"]
        taken[r["src"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = M.Mix(docs(spark, rows).repartition(7)).taken().select("row.doc_id", "taken").collect()
    assert sorted((r[0], r[1]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)


def test_ranges_do_not_change_the_result(spark, monkeypatch):
    rows = corpus(120, 4)
    one = {tuple(r) for r in M.Mix(docs(spark, rows)).taken().select("row.doc_id", "start", "taken").collect()}
    monkeypatch.setattr(M, "RANGE_ROWS", 10)
    monkeypatch.setattr(M, "CHUNK_SLOTS", 3)
    assert {tuple(r) for r in M.Mix(docs(spark, rows)).taken().select("row.doc_id", "start", "taken").collect()} == one


def test_slots_are_a_permutation_of_blocks_and_places(spark):
    mix = M.Mix(docs(spark, corpus()), block=16, shard_slots=50)
    slots = mix.slots.collect()
    sources = {r["source_no"]: r for r in mix.sources.collect()}
    places = sorted(r["shard"] * 50 + r["place"] for r in slots)
    assert places == list(range(len(slots)))
    by = collections.Counter((r["source_no"], r["round"], r["block"]) for r in slots)
    assert max(by.values()) == 1
    for no, s in sources.items():
        mine = [r for r in slots if r["source_no"] == no]
        assert sum(r["take"] for r in mine) == round(s["target"])
        n_blocks = -(-s["source_size"] // 16)
        assert all(0 <= r["block"] < n_blocks and 0 < r["take"] <= 16 for r in mine)
        for r in mine:
            if r["round"] < int(round(s["target"])) // s["source_size"]:
                index = r["source_slot"] - r["round"] * n_blocks
                assert r["block"] == brute_permuted(index, n_blocks, (("i", no), ("q", r["round"])))


def test_texts_hold_the_words_taken(spark):
    rows = corpus(150, 2)
    mix = M.Mix(docs(spark, rows))
    taken = {r[0]: r[1] for r in mix.taken().select("row.doc_id", "taken").collect()}
    text = {r[0]: r[1] for r in rows}
    found, rounds = collections.Counter(), collections.Counter()
    for r in mix.texts().select("row.doc_id", "round", "mixed_text").collect():
        part, whole = words(r["mixed_text"]), words(text[r["doc_id"]])
        found[r["doc_id"]] += len(part)
        rounds[r["doc_id"], r["round"]] += 1
        if len(part) == len(whole):
            assert r["mixed_text"] == text[r["doc_id"]]
        else:
            assert not collections.Counter(part) - collections.Counter(whole)
    assert max(rounds.values()) == 1
    assert {d: n for d, n in taken.items() if n} == dict(found)


def test_edge_rows_and_empty_table(spark):
    rows = M.Mix(docs(spark)).taken().select("row.doc_id", "size", "taken").collect()
    assert len(rows) == 12
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    empty = M.Mix(docs(spark).limit(0))
    assert empty.taken().count() == 0 and empty.texts().count() == 0 and empty.slots.count() == 0
    blank = M.Mix(docs(spark).where("text is null or trim(text) = ''"))
    assert {r["taken"] for r in blank.taken().collect()} == {0}

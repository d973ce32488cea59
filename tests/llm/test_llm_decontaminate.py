import itertools
import random
import re

import pytest
from llm_rows import LONG, PROSE, clash, docs

from eventlake.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    ("q1", PROSE), ("q2", "Quick, BROWN fox"), ("q3", "one"), ("q4", ""), ("q5", None), (None, "lazy dog"), ("q2", "Quick, BROWN fox"),
    ("q6", "word5 and5 word6 and6 word7 and7 word8 and8 word9 and9 word10 and10"), ("q7", "?!"), ("q8", "日本"),
]


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    w, hit, owners, ids = words(text), set(), set(), set()
    for number, (item, source) in enumerate(ITEMS):
        p = words(source)
        for size in {min(len(p), 10)} - {0}:
            for window in {tuple(p[i : i + size]) for i in range(len(p) - size + 1)}:
                for j in range(len(w) - size + 1):
                    if tuple(w[j : j + size]) == window:
                        hit.update(range(j, j + size))
                        ids.add(item)
    return len(w), len(hit), sorted(str(i) for i in ids if i is not None), len(ids)


def test_matches_brute_force(spark):
    bench = clash(spark.createDataFrame(ITEMS, "item_id string, text string"), "n_words")
    df = clash(docs(spark), "n_words", "spans", "leak")
    got = D.decontaminate(df, bench).select("text", "n_words", "leak.*")
    rows = got.collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r[1] == "mine-n_words"
        assert (r[2], r["n_hit"], r["item_ids"], r["n_items"]) == brute(r["text"])


def test_blocks_agree_and_spans_point_at_the_original():
    items = [i for i in ITEMS if i[1] is not None]
    texts = ["He said: Quick,brown--FOX! and so on, a lazy dog.", None, "", "fox " * 5000 + PROSE.upper(), LONG]
    one, many = D.Scanner(items).scan(texts), D.Scanner(items, block_chars=10).scan(texts)
    assert len(D.Scanner(items, block_chars=10).blocks) > 5
    assert one == many
    assert [texts[0][s["start"] : s["end"]] for s in one["spans"][0]] == ["Quick,brown--FOX", "lazy dog"]


def random_benchmark(rnd, n):
    """Items over few words, so that windows and anchors repeat within and across items."""
    vocab = ["a", "b", "c", "dd", "ee", "f1", "é", "日本"]
    return [(f"i{k}", " ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 3, 9, 10, 11, 15, 16, 30])))) for k in range(n)]


@pytest.mark.parametrize("window", [1, 2, 3, 4, 10])
def test_anchors_find_every_window(window):
    rnd = random.Random(window)
    for _ in range(60):
        items = random_benchmark(rnd, 12)
        texts = []
        for _ in range(8):
            parts = [" ".join(rnd.choices(["a", "b", "c", "dd", "zz"], k=rnd.randint(0, 8)))]
            for _ in range(rnd.randint(0, 3)):
                w = rnd.choice(items)[1].split()
                at = rnd.randint(0, len(w))
                parts.append(" ".join(w[at : at + rnd.randint(0, 20)]))
            texts.append(" ".join(parts))
        for chars in (D.BLOCK_CHARS, 30):
            got = D.Scanner(items, window, chars).scan(texts)
            for i, text in enumerate(texts):
                w, hit, owners = words(text), set(), set()
                for item, source in items:
                    p = words(source)
                    size = min(len(p), window)
                    for q in range(len(p) - size + 1 if size else 0):
                        for j in range(len(w) - size + 1):
                            if w[j : j + size] == p[q : q + size]:
                                hit.update(range(j, j + size))
                                owners.add(item)
                assert (got["n_hit"][i], got["item_ids"][i]) == (len(hit), sorted(owners)), (text, items)


def test_one_automaton_a_worker(spark):
    """Built once for all tasks of a worker, however many batches there are."""
    from pyspark.sql import functions as F

    df = docs(spark, [(i, f"{PROSE} {i}", "en", "a") for i in range(6000)]).repartition(12)
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    scanner = D.Scanner([i for i in ITEMS if i[1]], token="t")
    D.KEPT.clear()
    first = scanner.automaton(0)
    assert scanner.automaton(0) is first and D.Scanner([i for i in ITEMS if i[1]], token="t").automaton(0) is first
    assert D.decontaminate(df, bench).where(F.col("leak.n_hit") > 0).count() == 6000


def test_a_large_benchmark_costs_little_more_than_a_small_one():
    """5 MB of items against 50 kB: nodes by characters, time by text."""
    import time

    rnd = random.Random(0)
    vocab = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 9))) for _ in range(30_000)]
    zipf = list(itertools.accumulate(1 / k for k in range(1, len(vocab) + 1)))  # words as frequent as in prose
    draw = lambda k: " ".join(rnd.choices(vocab, cum_weights=zipf, k=k))
    make = lambda chars: [(str(i), draw(350)) for i in range(chars // 2200)]
    small, large = make(50_000), make(5_000_000)
    texts = [draw(500) for _ in range(2000)] + [large[7][1][:900], small[7][1][:900]]
    took, found = [], []
    for items in (small, large):
        scanner = D.Scanner(items, token=str(len(items)))
        assert len(scanner.blocks) == 1
        nodes = scanner.automaton(0).machine.get_stats()["nodes_count"]
        assert nodes < 0.5 * sum(len(t) for _, t in items)
        began = time.process_time()
        found.append(scanner.scan(texts)["n_hit"])
        took.append(time.process_time() - began)
    assert found[1][2000] > 100 and found[0][2001] > 100
    assert took[1] < 2 * took[0] + 0.3, took


def test_an_anchor_of_very_many_items():
    items = [(str(i), f"which of the following statements is true about subject{i} and its many known consequences for readers") for i in range(20_000)]
    scanner = D.Scanner(items)
    text = "which of the following statements is true about nothing " * 300 + items[77][1]
    assert scanner.scan([text])["item_ids"] == [["77"]]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id string, text string")
    assert {r[0] for r in D.decontaminate(docs(spark), none).select("leak.n_hit").collect()} == {0}
    assert D.decontaminate(docs(spark).limit(0), none).count() == 0

import random
import re

import numpy as np
import pytest
import xxhash
from llm_rows import LONG, PROSE, clash, docs

from eventlake.llm import simhash as S


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, d):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_is_the_definition():
    for text in [None, "", " \n", "One", "one TWO", PROSE, PROSE + "\x1f\x85 x", LONG[:9000], "é É"]:
        assert S.fingerprint(text) == brute_fingerprint(text)
    assert S.fingerprint(LONG * 3) == brute_fingerprint(LONG * 3)


def near_family(n, seed, d=2):
    """Numbers in chains, stars and pairs around the distance."""
    rnd, out = random.Random(seed), []
    while len(out) < n:
        base = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 6)):
            out.append(base)
            for bit in rnd.sample(range(64), rnd.randint(1, d + 1)):
                base ^= 1 << bit
    return sorted(set(out))[:n]


@pytest.mark.parametrize("d", [0, 1, 2, 3])
@pytest.mark.parametrize("limit", [S.RUN_LIMIT, 3])
def test_links_and_components_match_brute_force(spark, monkeypatch, d, limit):
    monkeypatch.setattr(S, "RUN_LIMIT", limit)
    fps = near_family(300, d) + [0, (1 << 64) - 1]
    if limit == 3:  # many distinct fingerprints under one key
        fps += [1 << a | 1 << b for a in range(64) for b in range(a, 64, 9)]
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r["node"] % (1 << 64): r["root"] for r in S.components(S.find_links(df, d)).collect()}
    want = brute_components(fps, d)
    label = {}
    for f, w in zip(fps, want):
        got = roots.get(f, f"single {f}")
        assert label.setdefault(w, got) == got
    assert len(set(label.values())) == len(label)


def test_a_run_over_the_limit_is_filed_under_finer_keys():
    import pyarrow as pa

    rnd = random.Random(5)
    fps = np.array(sorted({rnd.getrandbits(20) for _ in range(3000)}), np.uint64)
    mask = next(m for m in S.key_masks(0, 2) if m & (1 << 20) - 1 == 0)
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(p), mask, np.uint64).view(np.int64)), pa.array(np.zeros(len(p), np.int64)), pa.array(p.view(np.int64))],
        names=["mask", "key", "fp"]) for p in np.array_split(fps, 4)]
    out = list(S.pair_runs(iter(batches), 2))
    rows = [r for b in out for r in b.to_pylist()]
    assert not any(r["a"] is not None for r in rows)
    finer = {r["mask"] for r in rows}
    assert len(finer) == 10 and len(rows) == 10 * len(fps)


def test_edge_rows(spark):
    df = clash(docs(spark), "fp", "id", "component")
    rows = S.near_duplicates(df).collect()
    assert len(rows) == df.count()
    zero = [r for r in rows if r["fp"] == 0]
    assert len(zero) == 4 and {r["component"] for r in zero} == {3}
    assert {r["component"] for r in rows if r["id"] in (1, 2)} == {1}
    assert S.near_duplicates(df.limit(0)).count() == 0
    only_null = S.near_duplicates(df.where("doc_id is null and text is null")).collect()
    assert [(r["id"], r["component"]) for r in only_null] == [(None, None)]


def test_contract_query_matches_brute_force(spark, tmp_path):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        text = [rnd.choice(words) for _ in range(rnd.randint(0, 90))]
        for j in range(rnd.choice([1, 1, 2, 4])):
            rows.append((len(rows), " ".join(text)))
            if text:
                text = text[:]
                text[rnd.randrange(len(text))] = rnd.choice(words)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in S.op5_simhash(spark, str(tmp_path)).collect()}
    fps = [brute_fingerprint(t) for _, t in rows]
    want = brute_components(fps, 2)
    assert got == {i: (f"{f:016x}", w) for (i, _), f, w in zip(rows, fps, want)}

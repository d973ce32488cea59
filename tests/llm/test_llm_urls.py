import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import urls as U

URLS = [
    (1, "http://A.example.org/es/1"), (2, "https://b.example.org/en/12?q=1"), (3, "http://x.com/fr/"), (4, "http://x.com/de/9#t"),
    (5, "ftp://notcom/de/1"), (6, None), (7, ""), (8, "no scheme/at/all"), (9, "http://org"), (10, "http://spam-farm.net/a"),
    (11, "http://m.spam-farm.net/a?b"), (12, "http://x.net/\u00e9?http://y.com/de/"), (13, "http://" + "l" * 100_000 + ".net/p"),
    (10, "http://spam-farm.net/a"), (14, "http://example.org.evil.net/es/"), (15, "HTTP://EXAMPLE.ORG/ES/"),
]


def brute(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    best = max((r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)),
               key=lambda r: len(r.host + r.path), default=None)
    listed = set(host.split(".")) & set(U.LISTED_NAMES)
    return host, path, best and best.text, best.verdict if best else "block" if listed else "allow"


@pytest.mark.parametrize("max_bits", [U.MAX_BITS, 8])
def test_judges_like_brute_force(spark, max_bits):
    df = spark.createDataFrame(URLS, "page_id long, url string").withColumns({"host": F.lit("mine"), "key": F.lit("k"), "listed": F.lit(1)})
    universe = df.select(U.host_of(F.col("url")).alias("h"), F.concat(U.host_of(F.col("url")), U.path_of(F.col("url"))).alias("key"))
    made = U.UrlFilter(universe, universe.where(U.on_list(F.col("h"))), max_bits=max_bits)
    assert (made.shards > 1) == (max_bits == 8)
    got = made.judge(df)
    assert got.columns == ["page_id", "url", "host", "key", "listed", "judged"]
    rows = got.select("url", "host", "judged.*").collect()
    assert len(rows) == len(URLS)
    for r in rows:
        assert (r[2], r[3], r[4], r[6]) == brute(r["url"]), r


def test_keys_and_pages_are_dealt_once(spark):
    """However many shards there are, a page is written once, to its shard's folder."""
    df = spark.createDataFrame([(i, f"http://h{i % 50}.net/{i % 400}") for i in range(2000)], "page_id long, url string")
    universe = df.select(F.concat(U.host_of(F.col("url")), U.path_of(F.col("url"))).alias("key"))
    listed = universe.where(F.crc32(F.col("key").cast("binary")) % 3 == 0)
    made = U.UrlFilter(universe, listed, rules=(), max_bits=300)
    assert made.shards > 4
    judged = made.judge(df)
    files = judged.inputFiles()
    assert len({f.split("/url-pages-")[1].split("/")[0] for f in files}) == 1
    blocked = {r["key"] for r in listed.distinct().collect()}
    for r in judged.collect():
        assert r["judged"]["verdict"] == ("block" if r["judged"]["host"] + r["judged"]["path"] in blocked else "allow")


def test_cascade_is_exact_with_a_coarse_filter(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = U.Cascade.build(keys, rate=0.4)
    assert len(cascade.levels) > 3
    hashes = keys.select("listed", *(U.level_hash(F.col("key"), i + 1) for i in range(len(cascade.levels)))).toPandas()
    got = cascade.listed(hashes.iloc[:, 1:].to_numpy().astype(np.int64).view(np.uint64))
    assert (got == hashes["listed"].to_numpy()).all()


def test_empty_list_and_empty_table(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    judged = U.UrlFilter(none, none).judge(df).select("url", "judged.verdict").collect()
    assert all(r[1] == ("allow" if brute(r[0])[2] is None else brute(r[0])[3]) for r in judged)
    assert U.UrlFilter(none, none).judge(df.limit(0)).count() == 0

"""URL filters: host and path rules, then a Bloom filter cascade.

A url's key is its host (A-Z lower-cased) and path. Rules fit a host and its
subdomains where the path starts with theirs; the longest fitting rule wins.
Urls that no rule fits are judged by the list: a key on the list is blocked.

The cascade gives exact membership over the corpus's complete key universe.
Level 1 encodes the listed keys; level 2 those other keys that level 1 takes
for listed; level 3 the listed keys that level 2 takes for others; and so on
until nothing is mistaken. A key is looked up level by level until one denies
it: at an even level it is listed, at an odd one it isn't. Pages are judged
without a join; only building shuffles, on distinct keys.

The filters are the only thing broadcast. Their bits are bounded: when the
list would need more than ``max_bits``, keys are cut by hash into shards with a
cascade each. Keys and pages are dealt over folders by their shard once, a
large folder in several files; each shard's levels read its keys only, and its
pages meet its cascade only, so a task holds one bounded cascade and the work
doesn't grow with the number of shards.

Null urls and urls without ``://`` have an empty host and path; they are judged
like any other key. Repeated rows are judged alike. An empty list allows what
no rule blocks; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import free_name, materialise, small_batches, table

FALSE_POSITIVES = 0.01
#: Bits of all levels of one cascade (8 MB).
MAX_BITS = 1 << 26
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The production rules, longest match first decided at run time.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Names whose urls the production list holds, as a host or any subdomain label of one.
LISTED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """A struct (text, verdict) of the longest fitting rule, or null."""
    best = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        best = F.when(fits, found) if best is None else best.when(fits, found)
    return best if best is not None else F.lit(None).cast("struct<text:string,verdict:string>")


def level_hash(key: Column, level: int) -> Column:
    return F.xxhash64(F.lit(level), key)


class Bloom:
    """A Bloom filter over 64-bit level hashes."""

    def __init__(self, n: int, rate: float):
        self.bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        self.hashes = max(1, round(self.bits / max(n, 1) * math.log(2))) if n else 1
        self.words = np.zeros(-(-self.bits // 64), np.uint64)

    def fill(self, hashed: DataFrame) -> Bloom:
        """Set the bits of ``hashed(h)``: positions are merged to words on the
        executors, at most ``bits / 64`` of them reach the driver."""
        low, step = F.col("h").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("h", 32).bitwiseOR(F.lit(1))
        at = F.explode(F.array(*((low + step * i) % self.bits for i in range(self.hashes)))).alias("at")
        words = hashed.select(at).groupBy(F.floor(F.col("at") / 64).cast("long").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
        found = words.toArrow()
        self.words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return self

    def has(self, h: np.ndarray) -> np.ndarray:
        """Which of the hashes (unsigned) may be inside."""
        low, step = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
        inside = np.ones(len(h), bool)
        for i in range(self.hashes):
            at = (low + step * np.uint64(i)) % np.uint64(self.bits)
            inside &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return inside


class Cascade:
    """Exact membership in a list, for keys of the universe it was built over."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    @staticmethod
    def build(keys: DataFrame, rate: float = FALSE_POSITIVES) -> Cascade:
        """``keys(key, listed)``: the distinct keys of the universe, a written
        table or a part of one, as every level reads it."""
        sets = [keys.where("listed"), keys.where("not listed")]
        levels: list[Bloom] = []
        encode = sets[0]
        while n := encode.count():
            level = len(levels) + 1
            bloom = Bloom(n, rate).fill(encode.select(level_hash(F.col("key"), level).alias("h")))
            levels.append(bloom)
            if level > 64:
                raise RuntimeError("two different keys share 64 level hashes")
            mistaken = taken_for(sets[level % 2], level, bloom)
            sets[level % 2] = encode = materialise(mistaken, f"url-level{level}")
        return Cascade(levels)

    def listed(self, hashes: np.ndarray) -> np.ndarray:
        """``hashes``: a row per key, a column per level."""
        n = len(self.levels)
        denied = np.full(len(hashes), n + 1)
        open_ = np.arange(len(hashes))
        for level, bloom in enumerate(self.levels, 1):
            inside = bloom.has(hashes[open_, level - 1])
            denied[open_[~inside]] = level
            open_ = open_[inside]
        return denied % 2 == 0 if n else np.zeros(len(hashes), bool)


def taken_for(keys: DataFrame, level: int, bloom: Bloom) -> DataFrame:
    """The keys that the filter of a level lets through."""
    small_batches(keys.sparkSession)
    sent = keys.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = sent.value.has(batch.column(2).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(inside)).select(["key", "listed"])

    return keys.select("key", "listed", level_hash(F.col("key"), level).alias("h")).mapInArrow(run, keys.schema)


class UrlFilter:
    """Rules and the cascades of a list over the keys of a corpus."""

    def __init__(self, universe: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES,
                 rate: float = FALSE_POSITIVES, max_bits: int = MAX_BITS):
        """``universe`` and ``listed`` have a column ``key``; both may repeat keys."""
        self.rules = rules
        keys = universe.select("key", F.lit(False).alias("listed")).unionByName(listed.select("key", F.lit(True).alias("listed")))
        keys = materialise(keys.groupBy("key").agg(F.max("listed").alias("listed")), "url-universe")
        n = keys.agg(F.count(F.when(F.col("listed"), 1)), F.count("*")).first()
        # Level 1 holds the list, level 2 at most a hundredth of the others, the rest together less than a hundredth more.
        bits = -math.log(rate) / math.log(2) ** 2 * (n[0] + n[1] * rate) * 1.1
        self.shards = max(1, math.ceil(bits / max_bits))
        self.cascades = [Cascade.build(part, rate) for part in self.dealt(keys, F.col("key"), "url-keys")]

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.shards))

    def dealt(self, rows: DataFrame, key: Column, label: str) -> list[DataFrame]:
        """The rows of every shard, written once to a folder for each."""
        if self.shards == 1:
            return [rows]
        name = free_name(rows, "shard")
        written = materialise(rows.withColumn(name, self.shard(key).cast("int")).hint("rebalance", name), label, name)
        return [written.where(F.col(name) == s).drop(name) for s in range(self.shards)]

    def judge(self, df: DataFrame, url_col: str = "url", out: str = "judged") -> DataFrame:
        """``df`` with a struct column ``out``: host, path, rule, listed, verdict."""
        small_batches(df.sparkSession)
        kept = df.drop(out) if out in df.columns else df
        host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
        rows = kept.select(F.struct(*kept.columns).alias("row"), F.struct(host.alias("host"), path.alias("path")).alias("at"))
        key = F.concat("at.host", "at.path")
        parts = [self._pass(part, key, cascade) for part, cascade in zip(self.dealt(rows, key, "url-pages"), self.cascades)]
        rows = reduce(DataFrame.unionByName, parts)
        rule = fitting_rule(F.col("at.host"), F.col("at.path"), self.rules)
        verdict = F.coalesce(rule["verdict"], F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
        judged = F.struct("at.host", "at.path", rule["text"].alias("rule"), "listed", verdict.alias("verdict"))
        return rows.select(*(F.col("row")[c].alias(c) for c in kept.columns), judged.alias(out))

    def _pass(self, rows: DataFrame, key: Column, cascade: Cascade) -> DataFrame:
        """``rows`` with ``listed``, by the cascade of their shard."""
        width = len(cascade.levels)
        hashes = F.array(*(level_hash(key, i + 1) for i in range(width))) if width else F.array().cast("array<long>")
        sent = rows.sparkSession.sparkContext.broadcast(cascade)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = batch.column(2).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, width)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sent.value.listed(h))], names=["row", "at", "listed"])

        schema = T.StructType([*rows.schema.fields, T.StructField("listed", T.BooleanType())])
        return rows.select("row", "at", hashes.alias("h")).mapInArrow(run, schema)


def on_list(host: Column, names: tuple[str, ...] = LISTED_NAMES) -> Column:
    return F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, names)))


def op1_urls(spark, sf_dir):
    """Contract query: the verdict of every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    universe = pages.select(host.alias("host"), F.concat(host, path).alias("key"))
    judged = UrlFilter(universe, universe.where(on_list(F.col("host")))).judge(pages)
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


OP1_SQL = r"""
WITH part AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
ruled AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM part)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN list_has_any(string_split(host, '.'), ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])
            THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

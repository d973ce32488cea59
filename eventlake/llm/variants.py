"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling,
and the commoner form that each is taken for.

Words are counted over all texts first (DataFrame functions only), so what
follows grows with the distinct words. Two words differ by one inserted,
deleted or replaced code point exactly if their common prefix and suffix
together reach the longer length less one. ``Tiles`` holds words as rows of two
padded matrices of code points, aligned left and right, and compares two blocks
of rows at once.

Which blocks meet: let L be the shorter length and p the common prefix (at most
L), the place of the edit. The places 0..L are cut into intervals; words with
the edit in [a, b) share their first a and last L - b code points. So a word is
put, for every interval, in the group of that prefix and suffix, once as the
shorter or equal one (L its length) and once as the longer (L its length less
one), and only groups are compared, a pair in the one interval that holds its
p: it is credited once and no list of pairs is made. A group larger than
``GROUP_WORDS`` is halved at its interval's middle, until intervals are single
places, where a group has no more words than the square of the alphabet; so a
prefix that a third of all words share is spread over many groups and none is
capped. Groups are sorted by key in their task and streamed in blocks; what is
held is a block and, while a group lasts, its blocks.

Edge cases: null and empty texts have no words; null ids count as an empty
string in the typo hash; equal rows count each; very long runs are words like
any other, in blocks of fewer rows; ties of the largest n go to the smallest
word in code-point order; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventlake.llm.common import materialise, small_batches, table

RUN = "[A-Za-z\\u00C0-\\u00FF]"
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: One run in so many has a code point deleted by the contract's query.
TYPO = 31
#: Intervals that the places of a word are cut into at first.
INTERVALS = 4
#: Words of a group above which it is halved.
GROUP_WORDS = 2000
#: Rows of a block, and cells of its matrices for longer words.
BLOCK_ROWS, BLOCK_CELLS = 96, 1 << 15


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, typo: int | None = None) -> DataFrame:
    """(word, n): maximal letter runs of all texts with A-Z lower-cased, of at
    least ``min_length`` code points and ``min_count`` occurrences. With
    ``typo``, a run whose crc32 with its document's id ``typo`` divides loses
    the code point at crc32 modulo its length."""
    # Shorter runs cannot become words, and matching is leftmost and greedy, so
    # a run of enough letters is matched whole.
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))
    words = df.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("run")).select(
        "id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("word"))
    if typo:
        hashed = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "word").cast("binary"))
        words = words.withColumn("h", hashed).selectExpr(
            f"CASE WHEN h % {typo} = 0 THEN concat(substring(word, 1, int(h % length(word))), "
            "substring(word, int(h % length(word)) + 2)) ELSE word END AS word").where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def keyed(rows: DataFrame) -> DataFrame:
    """Rows (L, a, b, word, n) with ``h``, the hash of what the words of a
    group share. A collision only makes a group larger."""
    return rows.selectExpr("L", "a", "b", "xxhash64(substring(word, 1, a), right(word, greatest(L - b, 0))) AS h", "word", "n")


def groups(words: DataFrame, group_words: int = GROUP_WORDS, intervals: int = INTERVALS) -> DataFrame:
    """The rows (L, a, b, h, word, n) of all groups, none above ``group_words``
    unless its interval is a single place."""
    whole = words.selectExpr("word", "n", "explode(array(length(word), length(word) - 1)) AS L")
    cut = whole.selectExpr("word", "n", "L", f"explode(sequence(0, {intervals - 1})) AS i").selectExpr(
        "word", "n", "L", f"int(i * (L + 1) div {intervals}) AS a", f"int((i + 1) * (L + 1) div {intervals}) AS b").where("a < b")
    rows, key = keyed(cut), ["L", "a", "b", "h"]
    while True:
        large = rows.where("b - a > 1").groupBy(*key).count().where(f"count > {group_words}").select(key)
        large = materialise(large, "variant-groups")
        if large.isEmpty():
            return rows
        again = rows.join(large, key, "left_semi").selectExpr(
            "word", "n", "L", "explode(array(struct(a, int((a + b) div 2) AS b), struct(int((a + b) div 2) AS a, b))) AS i")
        halved = keyed(again.select("word", "n", "L", "i.a", "i.b"))
        rows = materialise(rows.join(large, key, "left_anti").unionByName(halved), "variant-rows")


class Tiles:
    """A block of words of one L: their groups and code points, and for each
    the near words found so far."""

    def __init__(self, L: int, rows: list[tuple]):
        self.L = L
        self.group, self.a, self.b = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        self.words = [r[3] for r in rows]
        self.n = np.array([r[4] for r in rows], np.int64)
        self.size = np.array([len(w) for w in self.words], np.int64)
        # One column more than the longest word, so that every comparison ends in the padding.
        inside = np.arange(L + 2) < self.size[:, None]
        self.left, self.right = np.zeros(inside.shape, np.uint32), np.zeros(inside.shape, np.uint32)
        self.left[inside] = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        self.right[inside] = np.frombuffer("".join(w[::-1] for w in self.words).encode("utf-32-le"), np.uint32)
        # The order in which a form is chosen: largest n, then the smallest word.
        order = sorted(range(len(rows)), key=lambda i: (-rows[i][4], self.words[i]))
        self.rank = np.argsort(np.array(order, np.int64))
        self.by_rank = order
        self.near = np.zeros(len(rows), np.int64)
        self.best: list[tuple[int, str] | None] = [None] * len(rows)

    def meet(self, other: Tiles) -> None:
        """Compare all rows with all rows of ``other``, and credit both."""
        same = self.group[:, None] == other.group
        if not same.any():
            return
        pads = [np.where(m == 0, 0xFFFFFFFF, m) for m in (other.left, other.right)]
        prefix, suffix = ((mine[:, None] == theirs).argmin(2) for mine, theirs in zip((self.left, self.right), pads))
        longer = np.maximum(self.size[:, None], other.size)
        shorter = np.minimum(self.size[:, None], other.size)
        place = np.minimum(prefix, self.L)
        near = (same & (shorter == self.L) & (prefix + suffix >= longer - 1) & (prefix < longer)
                & (self.a[:, None] <= place) & (place < self.b[:, None]))
        i, j = np.nonzero(near)
        if len(i):
            self.credit(i, j, other)
            if other is not self:
                other.credit(j, i, self)

    def credit(self, mine: np.ndarray, theirs: np.ndarray, other: Tiles) -> None:
        self.near += np.bincount(mine, minlength=len(self.near))
        least = np.full(len(self.near), len(other.words))
        np.minimum.at(least, mine, other.rank[theirs])
        for i in np.unique(mine).tolist():
            j = other.by_rank[least[i]]
            found = (-int(other.n[j]), other.words[j])
            if self.best[i] is None or found < self.best[i]:
                self.best[i] = found

    def found(self) -> Iterator[tuple]:
        for word, near, best in zip(self.words, self.near.tolist(), self.best):
            if near:
                yield word, near, -best[0], best[1]


def near_words(words: DataFrame, group_words: int = GROUP_WORDS, intervals: int = INTERVALS) -> DataFrame:
    """(word, n_near, best_n, best): of every word that has near words, their
    number, and the one of largest n (the smallest of them)."""
    small_batches(words.sparkSession)
    dealt = groups(words, group_words, intervals).repartition("L", "a", "h").sortWithinPartitions("L", "a", "h", "b", "word")
    schema = "word string, near long, best_n long, best string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Tiles] = []  # blocks that end in the group that the next may begin with
        rows: list[tuple] = []
        key, number = None, 0

        def block() -> Iterator[Tiles]:
            """Compare the rows gathered; blocks that can meet no more come out."""
            new = Tiles(key[0], rows)
            if held and held[-1].group[-1] != new.group[0]:
                yield from held
                held.clear()
            for old in held:
                old.meet(new)
            new.meet(new)
            if held and new.group[0] != new.group[-1]:
                yield from held
                held.clear()
            held.append(new)

        def out(done: list[Tiles]) -> pa.RecordBatch:
            found = [f for tiles in done for f in tiles.found()]
            columns = list(zip(*found)) or [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "near", "best_n", "best"])

        for batch in batches:
            done: list[Tiles] = []
            for L, a, b, h, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                full = rows and (L != key[0] or len(rows) >= BLOCK_ROWS or (len(rows) + 1) * (L + 2) > BLOCK_CELLS)
                if full:
                    done += block()
                    rows = []
                if (L, a, b, h) != key:
                    key, number = (L, a, b, h), number + 1
                rows.append((number, a, b, word, n))
            yield out(done)
        if rows:
            yield out([*block(), *held])

    parts = dealt.mapInArrow(run, schema)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("first")
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("first.n")).alias("best_n"), F.col("first.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by joining the
    table with itself until nothing changes. A form's n is ``RATIO`` times its
    word's, so chains are short and the rounds are their logarithm."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        seen = Observation()
        hop = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = now.join(hop, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        now = materialise(step.observe(seen, F.count("next").alias("moved")).select("word", "root"), "variant-roots")
        if not seen.get["moved"]:
            return now


def spelling_variants(words: DataFrame, ratio: int = RATIO, group_words: int = GROUP_WORDS, intervals: int = INTERVALS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of a (word, n) table
    of distinct words. ``form`` is the near word of largest n, where that is at
    least ``ratio`` times the word's."""
    words = materialise(words.select("word", F.col("n").cast("long").alias("n")), "variant-words")
    near = near_words(words, group_words, intervals)
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(F.when(F.col("best_n") >= ratio * F.col("n"), F.col(c)).alias(name) for c, name in (("best", "form"), ("best_n", "form_n"))))
    judged = materialise(judged, "variant-forms")
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_variants(spark, sf_dir):
    """Contract query: variants of the words of all documents."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), typo=TYPO))

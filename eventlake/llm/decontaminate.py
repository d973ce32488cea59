"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised alike on both sides: A-Z lower-cased, words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by one space. A document word is
hit if it lies inside an occurrence of ``window`` consecutive words of an item
(of the whole item, if it has fewer words, but not none).

The automaton doesn't hold the windows, which overlap and would repeat every
item word ``window`` times. It holds anchors: of every ``stride`` words of an
item the first ``anchor`` ones, with anchor + stride = window + 1, so that every
window contains a whole anchor, and the words of all anchors together are
fewer than the item's. A document is scanned once; where an anchor occurs, the
words around it are compared with the item's to both sides, and a common run of
at least ``window`` words is made of windows. An anchor that many items have is
compared with all of them at once. Hits are word numbers, and from there offsets
of the original text.

The automaton reads word codes: a few code points for each word of the items,
fewest distinct ones first for the frequent words, and as many of one that no
anchor has for any other word. That is shorter to read than the words, and what
is read often lies close together in a large automaton.

Memory of a worker: the automaton, about 15 bytes a benchmark character, the
distinct words, and the item words as 4-byte numbers. A worker builds it once and keeps it for all its
tasks. A benchmark of more than ``BLOCK_CHARS`` is cut into blocks of items, an
automaton each; a task then gathers ``CHUNK_CHARS`` of texts, passes them
through one block after another and builds each block's automaton once a
chunk. The items are gathered on the driver and sent to the executors behind a
check of their size (``max_benchmark_chars``), beyond which the call fails with
the size found rather than dropping items.

Null and empty texts have no words and are clean. Items without words never
occur; a null item id counts as an item and isn't listed. Repeated items with
one id count once. Rows are independent, so none is hot.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import append_struct, table

WINDOW = 10
#: Code points that a place of a word's code may have.
DIGITS = 64
#: Characters of the items of one automaton: some 300 MB of a worker's memory.
BLOCK_CHARS = 15_000_000
#: Characters of texts that pass through the blocks together, if there are several.
CHUNK_CHARS = 64_000_000
MAX_BENCHMARK_CHARS = 200_000_000

#: A-Z lower-cased, other ASCII that is no word character to a space.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("n_items", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
])


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def item_blocks(items: list[tuple[str | None, str | None]], block_chars: int) -> list[range]:
    """Neighbouring items, cut where they exceed ``block_chars``."""
    blocks, first, size = [], 0, 0
    for number, (_, text) in enumerate(items):
        size += len(text or "")
        if size > block_chars:
            blocks.append(range(first, number + 1))
            first, size = number + 1, 0
    return [*blocks, range(first, len(items))] if first < len(items) or not blocks else blocks


class Anchors:
    """The automaton of some items, and their words."""

    def __init__(self, items: list[tuple[str | None, str | None]], numbers: range, window: int):
        import ahocorasick

        self.window = window
        length = max(1, window // 2)
        stride = window + 1 - length
        texts = [normal_words(items[number][1]) for number in numbers]
        self.vocabulary = {w: i for i, (w, _) in enumerate(Counter(chain.from_iterable(texts)).most_common())}
        self.width = 1
        while DIGITS**self.width < len(self.vocabulary):
            self.width += 1
        self.codes = {w: "".join(chr(0x100 * (k + 1) + i // DIGITS**k % DIGITS) for k in range(self.width)) for w, i in self.vocabulary.items()}
        words: list[np.ndarray] = []
        #: Places, in all items' words, where a short item or an anchor begins.
        patterns: dict[str, tuple[int, list[int], list[int]]] = {}
        at = 0
        for mine in texts:
            # Each item is followed by a word that no text has.
            words.append(np.array([*(self.vocabulary[w] for w in mine), -1], np.int32))
            short = 0 < len(mine) < window
            for start in [0] if short else range(0, len(mine) - length + 1, stride):
                size = len(mine) if short else length
                key = "".join([self.codes[w] for w in mine[start : start + size]])
                # A short item and an anchor of the same words are both looked for.
                patterns.setdefault(key, (size, [], []))[1 if short else 2].append(at + start)
            at += len(mine) + 1
        self.words = np.concatenate([np.array([-1], np.int32), *words])
        self.starts = np.cumsum([0, *map(len, words)])
        self.numbers = numbers
        self.machine = ahocorasick.Automaton()
        for key in sorted(patterns):
            size, short, anchors = patterns[key]
            self.machine.add_word(key, (size, np.array(short, np.int64) + 1, np.array(anchors, np.int64) + 1))
        self.machine.make_automaton()

    def items_at(self, places: np.ndarray) -> set[int]:
        return {self.numbers[i] for i in (np.searchsorted(self.starts, places - 1, side="right") - 1).tolist()}

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Ranges of word numbers that occurrences of windows cover, and the
        items that have these."""
        ranges: list[tuple[int, int]] = []
        found: set[int] = set()
        if not words or not len(self.machine):
            return ranges, found
        ids = None
        done: dict[int, int] = {}  # alignment of text and item words: where its last run ends in the text
        other = "\x01" * self.width
        codes = "".join([self.codes.get(w, other) for w in words])
        for end, (size, short, anchors) in self.machine.iter(codes):
            if ids is None:
                ids = np.array([-2, *(self.vocabulary.get(w, -2) for w in words), -2], np.int32)
            p = (end + 1) // self.width - size  # the text word that the pattern begins at
            if len(short):
                ranges.append((p, p + size))
                found |= self.items_at(short)
            if len(anchors):
                self.extend(ids, p, size, anchors, done, ranges, found)
        return ranges, found

    def extend(self, ids: np.ndarray, p: int, size: int, anchors: np.ndarray, done: dict[int, int], ranges: list, found: set) -> None:
        """Compare the words around text word ``p`` with those around all the
        items' places ``anchors``."""
        reach = self.window - size
        q, before, after = anchors, np.zeros(len(anchors), np.int64), np.zeros(len(anchors), np.int64)
        # How far each goes on to both sides, up to the words that a window needs.
        for step, count in ((-1, before), (1, after)):
            going = np.arange(len(q))
            for k in range(1, reach + 1):
                text = p + 1 + (size - 1 if step > 0 else 0) + step * k  # text word numbers are one off in ids
                if not 0 < text < len(ids):
                    break
                going = going[self.words[q[going] + (size - 1 if step > 0 else 0) + step * k] == ids[text]]
                if not len(going):
                    break
                count[going] += 1
        for i in np.flatnonzero(before + after + size >= self.window).tolist():
            place = int(q[i])
            if done.get(place - p, -1) >= p + size:
                continue
            low = int(before[i])
            while self.words[place - low - 1] == ids[p + 1 - low - 1]:
                low += 1
            high = size + int(after[i])
            while self.words[place + high] == ids[p + 1 + high]:
                high += 1
            done[place - p] = p + high
            ranges.append((p - low, p + high))
            found |= self.items_at(np.array([place]))


#: A worker's automata, by the token of the call that sent the items.
KEPT: dict[str, Anchors] = {}


class Scanner:
    """The automata of a benchmark. With one block it is built once and kept by
    the worker under ``token``; with more, once for every call of ``scan``."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW, block_chars: int = BLOCK_CHARS,
                 token: str | None = None):
        self.items, self.window, self.token = items, window, token
        self.blocks = item_blocks(items, block_chars)

    def automaton(self, block: int) -> Anchors:
        if len(self.blocks) > 1 or self.token is None:
            return Anchors(self.items, self.blocks[block], self.window)
        if self.token not in KEPT:
            KEPT.clear()
            KEPT[self.token] = Anchors(self.items, self.blocks[block], self.window)
        return KEPT[self.token]

    def scan(self, texts: list[str | None]) -> dict[str, list]:
        """The fields of ``FIELDS`` for a batch of whole texts."""
        words = [normal_words(t) for t in texts]
        found: list[list[tuple[int, int]]] = [[] for _ in texts]  # ranges of words
        items: list[set[int]] = [set() for _ in texts]
        for block in range(len(self.blocks)):
            anchors = self.automaton(block)
            for i, w in enumerate(words):
                ranges, owners = anchors.scan(w)
                found[i] += ranges
                items[i] |= owners
        out: dict[str, list] = {f.name: [] for f in FIELDS}
        for text, w, ranges, owners in zip(texts, words, found, items):
            hit = hit_words(len(w), ranges)
            ids = sorted({str(self.items[k][0]) for k in owners if self.items[k][0] is not None})
            out["n_words"].append(len(w))
            out["n_hit"].append(int(hit.sum()))
            out["item_ids"].append(ids)
            out["n_items"].append(len(ids) + (1 if any(self.items[k][0] is None for k in owners) else 0))
            out["spans"].append(original_spans(text, hit) if ranges else [])
        return out


def hit_words(n: int, ranges: list[tuple[int, int]]) -> np.ndarray:
    """Which of ``n`` words lie inside the ranges."""
    hit = np.zeros(n + 1, np.int64)
    if ranges:
        starts, ends = np.array(ranges).T
        np.add.at(hit, starts, 1)
        np.add.at(hit, ends, -1)
    return np.cumsum(hit)[:-1] > 0


def original_spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Code-point ranges of the original text that runs of hit words cover."""
    spans: list[dict[str, int]] = []
    before = False
    for match, now in zip(WORD.finditer(text), hit.tolist()):
        if now and before:
            spans[-1]["end"] = match.end()
        elif now:
            spans.append({"start": match.start(), "end": match.end()})
        before = now
    return spans


def decontaminate(
    df: DataFrame, benchmark: DataFrame, out: str = "leak", text_col: str = "text", window: int = WINDOW,
    max_benchmark_chars: int = MAX_BENCHMARK_CHARS,
) -> DataFrame:
    """``df`` with a struct column ``out``: words, hit words, the occurring
    items and the original spans. ``benchmark`` has item_id and text."""
    size = benchmark.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    if size > max_benchmark_chars:
        raise ValueError(f"the benchmark has {size} characters, the bound is {max_benchmark_chars}")
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").collect()
    items = sorted(((r["item_id"], r["text"]) for r in rows), key=lambda x: (x[0] is not None, x))
    sent = df.sparkSession.sparkContext.broadcast(items)
    token, blocks = uuid.uuid4().hex, len(item_blocks(items, BLOCK_CHARS))
    return append_struct(df, out, FIELDS, Scanner.scan, text_col, lambda: Scanner(sent.value, window, token=token),
                         gather=CHUNK_CHARS if blocks > 1 else 0)


def op2_decontaminate(spark, sf_dir):
    """Contract query: contamination of every document by the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "leak.n_words", "leak.n_hit", "leak.n_items",
        F.sha2(F.concat_ws(",", "leak.item_ids"), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"))


OP2_SQL = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
pattern AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS p
  FROM item, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
place AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS p
  FROM doc, (SELECT DISTINCT size FROM pattern), unnest(range(1, greatest(0, len(w) - size + 1) + 1)) AS t(i)),
occurrence AS (SELECT doc_id, i, place.size, item_id FROM place JOIN pattern USING (size, p)),
hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, size FROM occurrence), unnest(range(i, i + size)) AS t(j) GROUP BY doc_id),
owner AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occurrence) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN owner USING (doc_id)
"""

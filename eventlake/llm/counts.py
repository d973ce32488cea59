"""Token counts: pieces counted once per distinct pre-token, joined to the
frequencies of pre-tokens in documents, and summed. No ids are kept.

A pre-token is a part of a text that no merge of the vocabulary can cross: a
run of spaces with what follows it up to the next space, or a character that
is in no piece of two or more characters and that texts use as a separator
(the line feed). ``Pieces`` derives both from the vocabulary and refuses one
for which they don't hold.

Documents are taken in blocks of about ``BLOCK_CHARS``. A block's frequencies
stay together: a row of a written table has, document by document, the numbers
and frequencies of its pre-tokens. Its distinct pre-tokens leave it once each,
whatever their frequency, in one row per hash bucket; so a word that is in every
document costs a row per block, and the hot keys are aggregated before any
shuffle. A bucket's words meet in one task, sorted, where each distinct one is
counted once; the counts go back to the blocks, which sum their documents.

Null texts count as empty: no bytes and no tokens. Rows with a null or repeated
id keep a row each; other columns are not read; an empty table gives no rows.
A very long text is a block's part like any other and is held whole by its
task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import give_back, materialise, small_batches, table
from eventlake.llm.vocab import PIECE, vocabulary

#: Characters of a block of documents; what a task holds is a few times that.
BLOCK_CHARS = 16 << 20
#: Words counted at a time.
WORDS_AT_ONCE = 100_000
#: Hash buckets of words for every shuffle partition, so that these even out.
BUCKETS_A_PARTITION = 4
#: Tokens above which a document is reported as over the limit.
TOKEN_LIMIT = 4096
SPACE = "▁"


class Pieces:
    """The vocabulary: cuts texts into pre-tokens and counts their pieces."""

    def __init__(self, name: str = PIECE, folder: str | None = None):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=vocabulary(name, folder))
        size = self.model.get_piece_size()
        joined = [p for i in range(size) if len(p := self.model.id_to_piece(i)) > 1
                  and not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        if any(SPACE in p.lstrip(SPACE) for p in joined) or any("\n" in p for p in joined):
            raise ValueError("a piece of this vocabulary crosses a pre-token")
        self.cut = re.compile(f"\n|[ {SPACE}]+[^ {SPACE}\n]*|[^ {SPACE}\n]+").findall
        # What the model puts before a text, and what a line feed after it adds.
        self.before_bare = len(self.model.encode("\n", num_threads=1))

    def pre_tokens(self, text: str | None) -> list[str]:
        """The pre-tokens of a text, which join to it behind the space that the
        model puts before every text."""
        return self.cut(" " + text) if text else []

    def count(self, words: list[str]) -> list[int]:
        """Pieces of each pre-token. One that begins with a space is given
        without it, as the model puts it back; any other is counted behind a
        line feed, which joins nothing."""
        spaced = [w[0] in (" ", SPACE) for w in words]
        given = [w[1:] if s else "\n" + w for w, s in zip(words, spaced)]
        ids = self.model.encode(given, num_threads=1)
        # The model gives no tokens for an empty text, where the space is one piece.
        return [(len(x) if g else 1) if s else len(x) - self.before_bare for x, g, s in zip(ids, given, spaced)]


@lru_cache(maxsize=1)
def pieces(name: str, folder: str | None) -> Pieces:
    return Pieces(name, folder)


def smallest(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the narrowest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)


def packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Unsigned integers, compressed. Of ``ascending`` runs, as of the word
    numbers of documents one after another, only the steps are kept."""
    if ascending and len(values):
        step = np.diff(values, prepend=0)
        values = 2 * np.where(step < 0, values, step) + (step < 0)
    values = smallest(values)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return bytes([values.itemsize]) + zlib.compress(planes.tobytes(), 1)


def unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    values = np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel().astype(np.int64)
    if not ascending or not len(values):
        return values
    # A run starts where the flag is set: there the sum starts anew.
    new, step = values & 1 == 1, values >> 1
    sums = np.cumsum(step)
    before = np.where(new, sums - step, 0)
    return sums - np.maximum.accumulate(before)


def frequencies(texts: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of some texts; distinct words per text; and text by text
    the numbers of its words with their frequencies."""
    number: dict[str, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    places = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, int(sizes.sum()))
    width = max(1, len(number))
    keys, times = np.unique(np.repeat(np.arange(len(texts)), sizes) * width + places, return_counts=True)
    return list(number), np.bincount(keys // width, minlength=len(texts)), keys % width, times


def blocks(df: DataFrame, id_col: str, text_col: str, name: str, folder: str | None) -> DataFrame:
    """The written table of blocks: a row per block with its documents
    (``words`` null), and a row per bucket of its words, the first of which has
    the number ``first`` in the block's order of buckets."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    buckets = BUCKETS_A_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = {
        "block": T.LongType(), "bucket": T.IntegerType(), "first": T.IntegerType(), "words": T.ArrayType(T.StringType()),
        "ids": T.ArrayType(rows.schema["id"].dataType), "n_bytes": T.ArrayType(T.LongType()),
        "distinct": T.BinaryType(), "numbers": T.BinaryType(), "times": T.BinaryType(), "buckets": T.BinaryType(),
    }
    schema = T.StructType([T.StructField(k, v) for k, v in fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        cut = pieces(name, folder).pre_tokens
        block = TaskContext.get().partitionId() << 32

        def table(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        def write(ids: list[pa.Array], texts: list[str]) -> Iterator[pa.RecordBatch]:
            words, distinct, numbers, times = frequencies([cut(t) for t in texts])
            of = np.array([zlib.crc32(w.encode()) % buckets for w in words], np.int64)
            order = np.argsort(of, kind="stable")
            ends = np.cumsum(np.bincount(of, minlength=buckets)).tolist()
            for at in range(0, buckets, 256):  # a few hundred buckets' words at a time
                cuts = [(b, ends[b - 1] if b else 0, ends[b]) for b in range(at, min(at + 256, buckets))]
                cuts = [c for c in cuts if c[1] < c[2]]
                if cuts:
                    yield table(block=[block] * len(cuts), bucket=[c[0] for c in cuts], first=[c[1] for c in cuts],
                                words=[[words[i] for i in order[lo:hi]] for _, lo, hi in cuts])
            yield table(block=[block], ids=[pa.concat_arrays(ids)], n_bytes=[[len(t.encode()) for t in texts]],
                        distinct=[packed(distinct)], numbers=[packed(numbers, True)], times=[packed(times)], buckets=[packed(of)])

        ids: list[pa.Array] = []
        texts: list[str] = []
        chars = 0
        for batch in batches:
            ids.append(batch.column(0))
            texts += [t or "" for t in batch.column(1).to_pylist()]
            chars += sum(map(len, texts[-batch.num_rows :])) if batch.num_rows else 0
            if chars >= BLOCK_CHARS:
                yield from write(ids, texts)
                ids, texts, chars, block = [], [], 0, block + 1
        if texts:
            yield from write(ids, texts)
        give_back()

    return materialise(rows.mapInArrow(run, schema), "count-blocks")


def count_pieces(words: DataFrame, name: str, folder: str | None) -> DataFrame:
    """(of_block, places, pieces) of (block, place, word) rows, in which equal
    words stand together: each distinct word is counted once. A row holds the
    counts of one block among ``WORDS_AT_ONCE`` rows."""
    schema = "of_block long, places binary, pieces binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(name, folder)
        last: tuple[str | None, int] = (None, 0)

        def count(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal last
            block, place = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
            words = [w for b in held for w in b.column(2).to_pylist()]
            new = np.array([a != b for a, b in zip(words, [last[0], *words])], bool)
            counts = np.array([last[1], *model.count([words[i] for i in np.flatnonzero(new)])], np.int64)[np.cumsum(new)]
            last = (words[-1], int(counts[-1]))
            order = np.lexsort((place, block))
            block, place, counts = block[order], place[order], counts[order]
            owners, starts = np.unique(block, return_index=True)
            cuts = list(zip(starts.tolist(), [*starts.tolist()[1:], len(block)]))
            return pa.RecordBatch.from_arrays(
                [pa.array(owners), pa.array([packed(place[a:b], True) for a, b in cuts], pa.binary()),
                 pa.array([packed(counts[a:b]) for a, b in cuts], pa.binary())], names=["of_block", "places", "pieces"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= WORDS_AT_ONCE or sum(b.nbytes for b in held) >= BLOCK_CHARS:
                yield count(held)
                held = []
        if held:
            yield count(held)

    return words.mapInArrow(run, schema)


def token_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT,
    name: str = PIECE, folder: str | None = None,
) -> DataFrame:
    """(``id_col``, n_bytes, n_tokens, over_limit) of every row of ``df``."""
    small_batches(df.sparkSession)
    written = blocks(df, id_col, text_col, name, folder)
    # A bucket's rows meet by its number and are cut into words only there.
    met = written.where("words IS NOT NULL").select("block", "bucket", "first", "words").repartition("bucket")
    words = met.select("block", "first", F.posexplode("words").alias("at", "word"))
    words = words.select("block", (F.col("first") + F.col("at")).alias("place"), "word").sortWithinPartitions("word")
    found = count_pieces(words, name, folder)
    documents = written.where("words IS NULL").drop("bucket", "first", "words")
    schema = T.StructType([
        T.StructField(id_col, written.schema["ids"].dataType.elementType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
    ])

    def add(block: pa.Table, counted: pa.Table) -> pa.Table:
        """The documents of one block: times x pieces, summed by document."""
        row = block.combine_chunks()
        of = unpacked(row.column("buckets")[0].as_py())
        placed = np.zeros(len(of), np.int64)
        for places, counts in zip(counted.column("places").to_pylist(), counted.column("pieces").to_pylist()):
            placed[unpacked(places, True)] = unpacked(counts)
        by_word = np.empty_like(placed)
        by_word[np.argsort(of, kind="stable")] = placed
        numbers = unpacked(row.column("numbers")[0].as_py(), True)
        distinct, times = (unpacked(row.column(c)[0].as_py()) for c in ("distinct", "times"))
        sums = np.concatenate([[0], np.cumsum(by_word[numbers] * times)])
        ends = np.cumsum(distinct)
        tokens = sums[ends] - sums[ends - distinct]
        ids, n_bytes = (row.column(c).chunk(0).flatten() for c in ("ids", "n_bytes"))
        return pa.Table.from_arrays([ids, n_bytes, pa.array(tokens), pa.array(tokens > limit)], names=schema.names)

    return documents.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(add, schema)


def op12_counts(spark, sf_dir):
    """Contract query: tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"))

"""Token-id output: shards of concatenated ids with Elias-Fano boundaries.

Documents are range-partitioned and sorted by id (nulls first; equal ids by a
hash of the text and then the text, so reruns agree and a repeated id doesn't
fill one task), encoded whole, closed with an end id and packed into shards of
about ``SHARD_TOKENS`` ids. A document is never cut. A shard is one row of a
Parquet table in the shared folder, so it is written by whichever executor
holds it and can be read by any other: ``part`` and ``seq`` give its place,
``part_start`` the ids before it in its part, ``doc_ids`` its documents, and
``payload`` the binary file: a header, the Elias-Fano code of the document
ends, and the ids in 16 or 32 bits, little-endian.

Encoding: pieces never span white space in this vocabulary, so a text's ids are
the ids of its blank-separated words one after another, and nor do they span
a letter and trailing punctuation; each distinct part goes through the
tokenizer, many in one text, and is remembered in a bounded cache. A text that
holds the string of a special token goes through the library whole, which by
default takes it for that token. Null and empty texts have the end id only.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm import elias_fano
from eventlake.llm.common import give_back, materialise, small_batches, table
from eventlake.llm.vocab import WORD, vocabulary

END_ID = 1
SHARD_TOKENS = 1 << 16
#: Words whose ids a worker keeps.
CACHED_WORDS = 1_200_000
PARTS_AT_ONCE = 100
#: A letter or digit, ASCII or Latin-1, that stays one when it is normalised.
ENDS_IN_LETTER = re.compile(rb".?[0-9A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]", re.S).fullmatch
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MAGIC = b"EFTOK001"
HEAD = struct.Struct("<8sIQQQ")  # magic, bytes of an id, documents, ids, bytes of the boundaries


class Numbers(dict):
    """Words numbered as they come; ``new`` are those not encoded yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Whole texts to ids by the words they consist of.

    A word is a core that ends in a letter or digit and a tail of ASCII
    punctuation, which the vocabulary never joins; ASCII cores are lower-cased,
    as it does; any other word is its own core. The
    ids of known parts lie one after another in ``flat``. When
    ``CACHED_WORDS`` are known, all are forgotten.
    """

    def __init__(self, name: str = WORD, folder: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary(name, folder))
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)").search
        self.forget()

    def forget(self) -> None:
        self.words, self.parts = Numbers(), Numbers()
        self.parts_of = np.zeros((0, 2), np.int32)
        self.flat = np.zeros(0, np.uint16)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self) -> None:
        """Split the new words and encode their new parts, some to a text; a
        token belongs to the part it starts in."""
        cores = [c if ENDS_IN_LETTER((c := w.rstrip(PUNCTUATION))[-2:]) else w for w in self.words.new]
        tails = [w[len(c) :] for w, c in zip(self.words.new, cores)]
        cores = [c.lower() if c.isascii() else c for c in cores]
        self.words.new.clear()
        number = self.parts.__getitem__
        pairs = [np.fromiter(map(number, x), np.int32, len(x)) for x in (cores, tails)]
        self.parts_of = np.concatenate([self.parts_of, np.column_stack(pairs)])
        new = [p.decode() for p in self.parts.new]
        self.parts.new.clear()
        texts = [new[at : at + PARTS_AT_ONCE] for at in range(0, len(new), PARTS_AT_ONCE)]
        done = self.tokenizer.encode_batch([" ".join(t) for t in texts], add_special_tokens=False)
        flat, count = [self.flat], [self.count]
        for text, encoded in zip(texts, done):
            starts = np.cumsum([0] + [len(p) + 1 for p in text])
            places = np.array([o[0] for o in encoded.offsets], np.int64)
            flat.append(np.array(encoded.ids, np.uint32))
            count.append(np.bincount(np.searchsorted(starts, places, side="right") - 1, minlength=len(text)))
        self.flat, self.count = np.concatenate(flat), np.concatenate(count)
        self.first = np.cumsum(self.count) - self.count

    def encode(self, texts: list[str | None], end_id: int) -> list[np.ndarray]:
        """Per text its ids and the end id."""
        if len(self.words) > CACHED_WORDS:
            self.forget()
        whole = {i: self.tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if t and self.special(t)}
        split = [[] if i in whole else (t or "").encode().split() for i, t in enumerate(texts)]
        sizes = [len(w) for w in split]
        words = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, sum(sizes))
        self.learn()
        parts = self.parts_of[words].ravel()
        count = self.count[parts]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.first[parts] - (ends - count), count) + np.arange(total)]
        cuts = np.concatenate([[0], ends])[2 * np.cumsum([0, *sizes])]
        end = np.array([end_id], np.uint32)
        return [np.concatenate([np.array(whole[i], np.uint32) if i in whole else ids[a:b], end])
                for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist()))]


@lru_cache(maxsize=1)
def encoder(name: str, folder: str | None) -> Encoder:
    """The worker's encoder: what one task has learnt serves the next."""
    return Encoder(name, folder)


def pack(documents: list[np.ndarray], width: int) -> bytes:
    """The binary shard of some documents' ids."""
    ends = np.cumsum([len(d) for d in documents], dtype=np.int64)
    bounds = elias_fano.encode(ends)
    ids = np.concatenate(documents).astype(f"<u{width}") if documents else np.zeros(0, f"<u{width}")
    return HEAD.pack(MAGIC, width, len(documents), len(ids), len(bounds)) + bounds + ids.tobytes()


class Shard:
    """A packed shard: ``shard[i]`` are the ids of its i-th document."""

    def __init__(self, payload: bytes):
        magic, width, self.n_docs, self.n_ids, size = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEAD.size
        self.bounds = elias_fano.EliasFano(payload[at : at + size])
        self.ids = np.frombuffer(payload, f"<u{width}", count=self.n_ids, offset=at + size)

    def ends(self) -> np.ndarray:
        return self.bounds.between(0, self.n_docs).astype(np.int64)

    def __getitem__(self, i: int) -> np.ndarray:
        first = self.bounds.select(i - 1) if i else 0
        return self.ids[first : self.bounds.select(i)]


def write_shards(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
    vocab: str = WORD, folder: str | None = None, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode and write ``df``; returns the written table of shards."""
    small_batches(df.sparkSession)
    kind = df.schema[id_col].dataType
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("h"))
    rows = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text").select("id", "text")
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
        T.StructField("part_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("payload", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab, folder)
        width = 2 if max(end_id, encode.tokenizer.get_vocab_size() - 1) < 1 << 16 else 4
        part = TaskContext.get().partitionId()
        ids: list[pa.Array] = []
        held: list[np.ndarray] = []
        seq = start = size = 0

        def shard() -> pa.RecordBatch:
            documents = pa.concat_arrays(ids)
            owners = pa.ListArray.from_arrays(pa.array([0, len(documents)], pa.int32()), documents)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([size], pa.int64()), owners, pa.array([pack(held, width)], pa.binary())],
                names=schema.names)

        for batch in batches:
            first = 0
            for i, encoded in enumerate(encode.encode(batch.column(1).to_pylist(), end_id)):
                held.append(encoded)
                size += len(encoded)
                if size >= shard_tokens:
                    ids.append(batch.column(0).slice(first, i + 1 - first))
                    yield shard()
                    seq, start, size, first = seq + 1, start + size, 0, i + 1
                    ids.clear()
                    held.clear()
            if first < batch.num_rows:
                ids.append(batch.column(0).slice(first))
        if held:
            yield shard()
        give_back()

    return materialise(rows.mapInArrow(run, schema), "token-shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shards.

    The driver gathers one number per part, as many as the writer had tasks.
    """
    small_batches(shards.sparkSession)
    sums = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, total = {}, 0
    for row in sums:
        base[row["part"]] = total
        total += row["n"]
    kind = shards.schema["doc_ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column("payload")[i].as_buffer().to_pybytes())
                ends = shard.ends()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = shard.ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                before = base[batch.column("part")[i].as_py()] + batch.column("part_start")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids").slice(i, 1).flatten(), pa.array(starts + before),
                     pa.array(ends - starts), pa.array(crc, pa.int64())],
                    names=schema.names)

    return shards.select("part", "part_start", "doc_ids", "payload").mapInArrow(run, schema)


def op7_tokens(spark, sf_dir):
    """Contract query: write the shards of all documents and read them back."""
    return read_documents(write_shards(table(spark, sf_dir, "documents")))

import random

import numpy as np
import pytest
from llm_rows import LONG, TEXTS, clash, docs

from eventlake.llm import counts as C

HARD = ["a", "b", "the", "  ", " ", "\n", "▁", "\t", "é", "日", "<s>", "</s>", "<unk>", "\x00", "　", "\xa0", "\U0001f600", "ﬁ",
        "<0x0A>", "ing", ".", "!!", "\r", "    ", "​", "́", "\x85"]


@pytest.fixture(scope="module")
def pieces():
    return C.Pieces()


def whole(pieces, text):
    return len(pieces.model.encode(text or ""))


def test_pre_tokens_add_up_to_the_library(pieces):
    rnd = random.Random(3)
    texts = ["", " ", "\n", "\n\n a", LONG, "x" * 50_000] + ["".join(rnd.choices(HARD, k=rnd.randint(1, 14))) for _ in range(8000)]
    for t in texts:
        words = pieces.pre_tokens(t)
        assert "".join(words) == (f" {t}" if t else "")
        assert sum(pieces.count(words)) == whole(pieces, t), t


def test_a_vocabulary_that_crosses_pre_tokens_is_refused(monkeypatch):
    from sentencepiece import SentencePieceProcessor

    monkeypatch.setattr(SentencePieceProcessor, "id_to_piece", lambda self, i: "a▁b")
    with pytest.raises(ValueError, match="crosses"):
        C.Pieces()


def test_frequencies():
    words, distinct, numbers, times = C.frequencies([["b", "a", "b"], [], ["c", "a"]])
    assert (words, distinct.tolist()) == (["b", "a", "c"], [2, 0, 2])
    assert (numbers.tolist(), times.tolist()) == ([0, 1, 1, 2], [2, 1, 1, 1])
    assert [x.tolist() for x in C.frequencies([[], []])[1:]] == [[0, 0], [], []]
    for values in ([], [0], [0, 255], [256], [70_000, 3], [5, 9, 0, 4, 4, 1]):
        for ascending in (False, True):
            assert C.unpacked(C.packed(np.array(values, np.int64), ascending), ascending).tolist() == values
    rnd = np.random.default_rng(1)
    runs = np.concatenate([np.unique(rnd.integers(0, 300_000, n)) for n in rnd.integers(0, 50, 400)])
    assert C.unpacked(C.packed(runs, True), True).tolist() == runs.tolist()


@pytest.mark.parametrize("limit,chars,words", [(C.TOKEN_LIMIT, C.BLOCK_CHARS, C.WORDS_AT_ONCE), (3, 200, 7)])
def test_counts_of_documents(spark, pieces, monkeypatch, limit, chars, words):
    monkeypatch.setattr(C, "BLOCK_CHARS", chars)
    monkeypatch.setattr(C, "WORDS_AT_ONCE", words)
    df = clash(docs(spark), "words", "block", "place", "n_bytes", "bucket", "ids").repartition(3)
    got = C.token_counts(df, limit=limit)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(d, len((t or "").encode()), n := whole(pieces, t), n > limit) for d, t, *_ in TEXTS]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert C.token_counts(docs(spark).limit(0)).count() == 0


def test_words_cross_the_shuffle_once_per_block(spark):
    same = docs(spark, [(i, "alpha beta alpha", "en", "a") for i in range(3000)]).coalesce(2)
    held = C.blocks(same, "doc_id", "text", C.PIECE, None)
    words = [w for r in held.where("words IS NOT NULL").collect() for w in r["words"]]
    assert sorted(set(words)) == [" alpha", " beta"] and len(words) <= 4
    assert held.where("words IS NULL").selectExpr("sum(size(ids))").first()[0] == 3000
    assert {r["n_tokens"] for r in C.token_counts(same).collect()} == {len(C.Pieces().model.encode("alpha beta alpha"))}

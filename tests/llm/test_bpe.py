import random

import pytest

from placemill.llm import bpe
from placemill.llm.queries import word_vocabulary
from tests.llm.helpers import awkward, table

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def theirs():
    return tokenizers.Tokenizer.from_file(word_vocabulary())


@pytest.fixture(scope="module")
def ours():
    with open(word_vocabulary(), encoding="utf-8") as f:
        return bpe.WordBPE(f.read())


def test_as_the_library_does(ours, theirs):
    rng = random.Random(2)
    pool = "abcdethrsn'  \n\t\x85\x1c\xa0²½_éÉñİΣς<|endoftext|>129ﬁ  ​\x00!?#💩한글"
    for i in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
        text += "<|endoftext|>it's" * (i % 3 == 0) + "THERING" * 60 * (i % 100 == 0)
        ids = ours.encode(text)
        assert ids == theirs.encode(text, add_special_tokens=False).ids
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_long_words_go_through_the_heap(ours, theirs):
    for word in ("ab" * 3000, "the" * 500 + "é" * 77, "a" * 101):
        assert ours.encode(word) == theirs.encode(word, add_special_tokens=False).ids
    parts = [ours.inner[b] for b in b"thethering" * 9]
    assert ours._merge_short(list(parts)) == ours._merge_long(list(parts))


def test_cache_is_bounded(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    with open(word_vocabulary(), encoding="utf-8") as f:
        small = bpe.WordBPE(f.read())
    text = " ".join(f"word{chr(97 + i)}x" for i in range(20)) * 2
    assert small.encode(text) == theirs.encode(text, add_special_tokens=False).ids and len(small.known) <= 6


def test_columns(spark, theirs):
    docs = table(spark, awkward())
    coded = bpe.decode(bpe.encode(docs, word_vocabulary()), word_vocabulary())
    assert set(coded.columns) == {*docs.columns, "decoded"}
    got = coded.select("text", "ids", "decoded").collect()
    assert len(got) == len(awkward())
    for r in got:
        want = theirs.encode(r["text"] or "", add_special_tokens=False).ids
        assert list(r["ids"]) == want and r["decoded"] == theirs.decode(want, skip_special_tokens=False)
    assert bpe.encode(table(spark, []), word_vocabulary()).count() == 0

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from placemill.llm import alignment
from placemill.llm.bpe import byte_letters
from placemill.llm.queries import vocabulary
from tests.llm.helpers import awkward, prose, table

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ODD = ["<|endoftext|>", "<s>", "</s>", "<unk>", "▁", " ", "\n", "\t", "  ", "日本", "🙂", "é", "ﬁ", " ", "​", "\x00", "don't", "'LL", "x", "12", "½", "\u0085", "᠎", "﻿", "ß"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(tools, text):
    """Ids and their bytes by the libraries, none if the bytes are not the text's."""
    a, b = tools
    if not text:
        return [], [], [], []
    byte_of = {c: i for i, c in enumerate(byte_letters())}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces, strict=True)]
    whole = (" " + text).encode()
    return (ids_a, ids_b, bytes_a, bytes_b) if b"".join(bytes_a) == b"".join(bytes_b) == whole else ([], [], [], [])


def brute(tools, rows):
    per, count = [], Counter()
    for doc_id, text, *_ in rows:
        ids_a, ids_b, bytes_a, bytes_b = tokens(tools, text)
        spans = []
        for side in (bytes_a, bytes_b):
            end, own = 0, []
            for t in side:
                own.append((end, end := end + len(t)))
            spans.append(own)
        links = [(ids_a[i], ids_b[j]) for i, (s, e) in enumerate(spans[0]) for j, (s2, e2) in enumerate(spans[1]) if s < e2 and s2 < e]
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, last = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, own, strict=True) if last <= s and e <= end)
                                   for ids, own in ((ids_a, spans[0]), (ids_b, spans[1]))))
            last = end
        count.update(set(links))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        per.append((doc_id, len(ids_a), len(ids_b), len(groups), links, digest))
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    return sorted([(d, a, b, g, len(ls), sum(count[x] == highest[x[0]] for x in ls), sum(count[x] for x in ls), h) for d, a, b, g, ls, h in per], key=str)


def mixed_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) if rng.random() < 0.4 else rng.choice(["", " "]) + prose(1, rng.random()) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def test_gallop():
    rng = np.random.default_rng(2)
    for n, k in ((1, 1), (50, 9), (1000, 400)):
        long, short = np.sort(rng.choice(5000, n, replace=False)), np.sort(rng.choice(5000, k, replace=False))
        for guess in (np.zeros(k, int), np.full(k, n), rng.integers(-5, n + 5, k)):
            assert (alignment.gallop(short, long, guess) == np.searchsorted(long, short)).all()


def test_ids_equal_the_libraries(tools):
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        v = alignment.Vocabularies(a.read(), b.read())
    assert v.a is not None
    texts = mixed_texts(400, 5) + [None, "", " ", "a" * 20_000, " " * 20_000, "\n" * 5000, prose(3000, 1)]
    ids_a, ids_b, n_a, n_b = v.encode(texts)
    want = [tokens(tools, t) for t in texts]
    assert n_a.tolist() == [len(w[0]) for w in want] and n_b.tolist() == [len(w[1]) for w in want]
    assert ids_a.tolist() == [i for w in want for i in w[0]] and ids_b.tolist() == [i for w in want for i in w[1]]
    assert sum(not w[0] for w in want) > 3 and sum(bool(w[0]) for w in want) > 100
    assert v.encode_a(" <|endoftext|>") == tools[0].encode(" <|endoftext|>", add_special_tokens=False).ids


def test_equals_brute_force(spark, tools, monkeypatch):
    monkeypatch.setattr(alignment, "PACK_CHARS", 700)
    rows = [(i, t, "en", "a") for i, t in enumerate(mixed_texts(120, 9))] + [(i, t, "", "") for i, t in enumerate([prose(40, 1)] * 30)]
    rows += [(None, None, None, None), (None, "", None, None), (7, prose(300, 2), "", "")]
    got = alignment.agreement(table(spark, rows).repartition(3), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(tools, rows)


def test_awkward_rows(spark, tools):
    rows = [(d, t if t is None or len(t) < 5000 else t[:3000], *x) for d, t, *x in awkward()]
    assert sorted([tuple(r) for r in alignment.agreement(table(spark, rows), A, B).collect()], key=str) == brute(tools, rows)
    long = alignment.agreement(table(spark, awkward()), A, B).collect()
    assert len(long) == len(awkward()) and all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in long)


def test_groups(spark, tools):
    rows = [(i, t, "", "") for i, t in enumerate(mixed_texts(40, 3))]
    for r in alignment.aligned(table(spark, rows), A, B).collect():
        ids_a, ids_b, bytes_a, bytes_b = tokens(tools, rows[r["doc_id"]][1])
        assert r["a_ids"] == ids_a and r["b_ids"] == ids_b
        cut = [(b"".join(bytes_a[:g["a_end"]]), b"".join(bytes_b[:g["b_end"]])) for g in r["groups"]]
        assert all(x == y for x, y in cut) and (not ids_a or cut[-1][0] == b"".join(bytes_a))


def test_empty_table(spark):
    assert alignment.agreement(table(spark, []), A, B).count() == 0

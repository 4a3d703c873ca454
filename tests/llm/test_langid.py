import math
import zlib
from collections import Counter

import pytest

from placemill.llm import langid
from tests.llm.helpers import awkward, table

WORDS = {"en": "the and of thing water house with never", "de": "der und nicht schön haus wasser über ein", "fr": "le la été maison avec eau jamais où"}


def corpus():
    rows = []
    for i in range(150):
        lang = list(WORDS)[i % 3]
        words = WORDS[lang].split()
        rows.append((i, " ".join(words[(i * k) % 8] for k in range(1, 9)), lang, "s"))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in langid.identify(table(spark, rows)).collect()}
    for doc_id, _, lang, _ in rows:
        assert got[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert got[doc_id]["lang_pred"] == lang and 0.9 < got[doc_id]["score"] <= 1


def test_counts_and_bounds(spark):
    model = langid.fit(table(spark, corpus()), train_docs=30)
    assert model.langs == ["de", "en", "fr"] and model.log_p.shape == (3, langid.SLOTS)


def test_awkward_rows(spark):
    got = langid.identify(table(spark, awkward() + [(100, "日本 한국", None, None), (101, "𐐨𐐩", None, None)])).collect()
    assert len(got) == len(awkward()) + 2
    und = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert {5, 6, 7, 13} <= und and und <= {5, 6, 7, 13, None}
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")


def test_nothing_to_learn_from(spark):
    got = langid.identify(table(spark, [(1, "some text", None, "a")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]
    assert langid.identify(table(spark, [])).count() == 0


def test_keep_known_keeps_all_columns(spark):
    docs = table(spark, corpus() + awkward())
    kept = langid.keep_known(docs, langid.fit(docs), 0.5)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and set(range(16, 150)) <= set(ids) and ids.count(13) == 1


@pytest.mark.parametrize("piece", [7, 1 << 18])
def test_scores_equal_plain_bayes(spark, monkeypatch, piece):
    """Counts, smoothing, likelihoods and posteriors by their definitions."""
    monkeypatch.setattr(langid, "PIECE", piece)
    rows = corpus() + [(1000 + i, t, lang, s) for i, (_, t, lang, s) in enumerate(awkward()) if t is None or len(t) < 3000]
    counts = {}
    for _, text, lang, _ in rows:
        if lang is not None and text:
            slots = langid.gram_slots(text).tolist()
            if slots:
                counts.setdefault(lang, Counter()).update(slots)
    sums = {lang: sum(c.values()) + langid.SMOOTHING * langid.SLOTS for lang, c in counts.items()}
    model = langid.fit(table(spark, rows))
    texts = [t for _, t, *_ in rows]
    for text, name, score in zip(texts, *model.predict(texts), strict=True):
        slots = Counter(langid.gram_slots(text).tolist())
        if not slots:
            assert (name, score) == ("und", 0.0)
            continue
        logs = {lang: sum(n * math.log((counts[lang][k] + langid.SMOOTHING) / sums[lang]) for k, n in slots.items()) for lang in counts}
        best = max(logs.values())
        assert logs[name] == pytest.approx(best, abs=1e-6) and score == pytest.approx(1 / sum(math.exp(v - best) for v in logs.values()), abs=1e-6)

import hashlib
import re
from collections import Counter

import pytest

import corpus_pipeline
from placemill.llm import langid, minhash, mixing
from placemill.llm.queries import word_vocabulary
from tests.llm.helpers import awkward, edited, prose, stored, table
from tests.llm.test_exact import LOWER
from tests.llm.test_minhash import brute_classes, idf_of

tokenizers = pytest.importorskip("tokenizers")


def corpus():
    rows = awkward()
    for i in range(60):
        text = prose(50 + i, 300 + i % 20)
        rows.append((500 + i, edited(text, i) if i % 3 == 0 else text, "en", f"s{i % 4}"))
    return rows


def unit(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16) / float(1 << 48)


def plain_copies(rows):
    """How often the mix takes each document (doc_id, text, source)."""
    told = lambda v: "null" if v is None else str(v)
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t, _ in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    total = {s: sum(size[d] for d, _, of in rows if of == s) for s in sources}
    target, free, left = {}, set(sources), sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 3 * total[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: float(3 * total[s]) for s in full}
        left, free = left - sum(3 * total[s] for s in full), free - full
    blocks = {}
    for d, _, s in rows:
        block = int(unit(told(d)) * -(-sum(of == s for *_, of in rows) // 1000))
        blocks.setdefault((s, block), []).append((size[d], unit(told(d)), d))
    copies = {}
    for (s, block), members in blocks.items():
        rate = target[s] / total[s] if total[s] else 0.0
        for n, (_, _, d) in enumerate(sorted(members, key=lambda m: (m[0], m[1])), 1):
            step = n * mixing.GOLDEN + unit(f"{told(s)}/{block}")
            copies[d] = int(rate) + (step % 1 < rate % 1)
    return copies


def test_run_equals_brute_force(spark, tmp_path):
    rows = corpus()
    table(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    by_text = {}
    for r in rows:
        key = r[1].translate(LOWER)
        if key not in by_text or (r[0] is not None, r[0] or 0) > (by_text[key][0] is not None, by_text[key][0] or 0):
            by_text[key] = r
    rows = list(by_text.values())
    texts = [r[1] for r in rows]
    firsts = {}
    for r, label in zip(rows, brute_classes(texts, idf_of(texts)), strict=True):
        if label not in firsts or (r[0] is None, r[0] or 0) < (firsts[label][0] is None, firsts[label][0] or 0):
            firsts[label] = r
    rows = list(firsts.values())
    texts = {r[0]: r[1] for r in rows}
    theirs = tokenizers.Tokenizer.from_file(word_vocabulary())
    copies = Counter(r["doc_id"] for r in got)
    assert copies == Counter({d: n for d, n in plain_copies([(r[0], r[1], r[3]) for r in rows]).items() if n}) and max(copies.values()) <= 3
    assert len(rows) > 30 and len(copies) > 20
    for r in got:
        want = theirs.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert list(r["ids"]) == want and r["n_tokens"] == len(want)
        assert r["decoded_sha256"] == hashlib.sha256(theirs.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_languages_by_themselves(spark, tmp_path):
    """The first stage keeps the documents whose best language is told with one half at least, and no others."""
    rows = corpus() + [(900 + i, "xq zz jj"[:2 + i % 7], "de", "a") for i in range(20)]
    docs = stored(spark, rows, tmp_path)
    model = langid.fit(docs)
    told = [model.predict([t]) for _, t, *_ in rows]
    want = Counter((r[0], r[1]) for r, ((lang,), (score,)) in zip(rows, told, strict=True) if lang != "und" and score >= 0.5)
    kept = corpus_pipeline.known_language(spark, docs, str(tmp_path))
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == want and kept.columns == docs.columns


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    table(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_similarity_is_the_operators(spark):
    assert minhash.SIMILARITY == 0.8 and minhash.SHINGLE == 5

import random

import pytest
from pyspark.sql import functions as F

from placemill.llm import repeats
from tests.llm.helpers import awkward, prose, table


def brute(rows):
    """Removed byte positions by looking up every 50-byte string."""
    texts = [(repeats.NO_ID if d is None else d, i, (t or "").encode()) for i, (d, t, *_) in enumerate(rows)]
    least = {}
    for d, _, data in texts:
        for p in range(len(data) - 49):
            w = data[p:p + 50]
            least[w] = min(least.get(w, d), d)
    out = {}
    for d, i, data in texts:
        gone = [False] * len(data)
        for p in range(len(data) - 49):
            if least[data[p:p + 50]] < d:
                gone[p:p + 50] = [True] * 50
        out[i] = bytes(b for b, g in zip(data, gone, strict=True) if not g), gone
    return out


def check(spark, rows):
    want = brute(rows)
    got = repeats.repeats(table(spark, rows)).collect()
    expected = sorted((str(rows[i][0]), kept, sum(gone)) for i, (kept, gone) in want.items())
    assert sorted((str(r["doc_id"]), bytes(r["kept"]), sum(s["end"] - s["start"] for s in r["spans"])) for r in got) == expected
    for r in got:
        assert r["n_bytes"] == len(r["kept"]) + sum(s["end"] - s["start"] for s in r["spans"])
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))


def test_passages_of_all_lengths(spark):
    rng, source = random.Random(4), prose(4000, 77)
    rows = []
    for i in range(120):
        pieces = []
        for _ in range(rng.randint(1, 4)):
            at, n = rng.randrange(len(source) - 200), rng.choice([30, 48, 49, 50, 51, 52, 60, 75, 120])
            pieces += [prose(rng.randint(0, 12), rng.random()), source[at:at + n]]
        rows.append((rng.randrange(10**6), "é".join(pieces), "en", "a"))
    check(spark, rows)


def test_periodic_texts(spark):
    check(spark, [(3, "ab" * 200, "", ""), (1, "ab" * 40, "", ""), (2, "a" * 49, "", ""), (4, "a" * 500, "", ""), (5, "b" + "a" * 60, "", ""), (6, "abc" * 100, "", "")])


def test_awkward_rows(spark):
    check(spark, awkward())


def test_empty_table(spark):
    assert repeats.repeats(table(spark, [])).count() == 0


@pytest.mark.parametrize("pack_bytes,range_bytes", [(300, 200), (5000, 1 << 30)])
def test_packs_and_ranges_do_not_matter(spark, monkeypatch, pack_bytes, range_bytes):
    monkeypatch.setattr(repeats, "RANGE_BYTES", range_bytes)
    passage = prose(30, 8)
    rows = [(i, f"{prose(10, i)} {passage} {prose(5, i % 7)}", "", "") for i in range(60)]
    check(spark, rows)


def test_a_pack_gets_its_own_answers_only(spark):
    long_texts = spark.range(12).coalesce(1).select(F.col("id").alias("doc_id"), F.repeat(F.md5(F.col("id").cast("string")), 1 << 15).alias("text"))
    packs = repeats.packed(long_texts)
    assert packs.count() > 1
    answers = repeats._answered(repeats._messages(packs, 1, 4), 1).cache()
    assert repeats._with_answers(packs, [answers]).select(F.sum(F.size("answers"))).first()[0] == answers.count()
    answers.unpersist()

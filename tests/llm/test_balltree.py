import math
import random
from collections import Counter

import numpy as np

from placemill.llm import balltree
from tests.llm.helpers import VOCABULARY, awkward, prose, table


def brute(rows, items, top=balltree.TOP):
    """Every score by its definition."""
    docs = [(d, balltree.terms(t)) for d, t, *_ in rows]
    docs = [(d, Counter(own)) for d, own in docs if own]
    n, length = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for d, c in docs:
            m = 100 - 50 + (50 * c.total() * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(balltree.terms(text)) if c[t])
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item_id, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def ranked(spark, rows, items, top=balltree.TOP):
    frame = spark.createDataFrame(items, "item_id long, text string")
    return sorted([tuple(r) for r in balltree.rank(table(spark, rows).repartition(5), frame, top).collect()], key=str)


def test_terms():
    assert balltree.terms("A-b é_É 10x\x7f\x85 Z") == [b"a", b"b", "é".encode(), "É".encode(), b"10x", "\x85".encode(), b"z"]
    assert balltree.terms(None) == balltree.terms("") == balltree.terms("-- ") == []


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(balltree, "LEAF_DOCS", 8)
    monkeypatch.setattr(balltree, "FLOOR_DOCS", 50)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(VOCABULARY[:400], k=rng.randint(1, 60))), "en", "a") for i in range(600)]
    rows += [(1000 + i, rows[i % 3][1], "en", "a") for i in range(120)]  # more copies than results
    items = [(i, " ".join(rng.choices(VOCABULARY[:450], k=rng.randint(1, 20)))) for i in range(20)] + [(90, rows[0][1]), (91, rows[1][1].upper())]
    assert ranked(spark, rows, items) == brute(rows, items)
    assert ranked(spark, rows, items, 3) == brute(rows, items, 3)


def test_awkward_rows(spark):
    items = [(1, prose(10, 1)), (1, prose(10, 1)), (2, None), (3, ""), (4, "éÉ one"), (None, "line one"), (5, "unseen-term-xyz"), (6, prose(400, 2))]
    rows = awkward()
    assert ranked(spark, rows, items) == brute(rows, items)


def test_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(balltree, "ITEMS", 2)
    rows = [(i, prose(30, i), "en", "a") for i in range(40)]
    items = [(i, prose(12, 100 + i)) for i in range(5)]
    assert ranked(spark, rows, items) == brute(rows, items)


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "x")]) == [] and ranked(spark, awkward(), []) == []
    assert ranked(spark, [(1, None, "", ""), (2, "--", "", "")], [(1, "x")]) == []


def test_values_beyond_64_bits():
    sizes = np.array([1 << 40, 3], np.int64)
    got = balltree.values(np.array([5, 1], np.int64), np.array([1, 1]), sizes, 1 << 30, 1 << 45)
    assert got.tolist() == [1_000_000_000 * tf // (1000 * tf + 20 * (50 + 50 * n * (1 << 30) // (1 << 45))) for tf, n in ((5, 1 << 40), (1, 3))]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(300, 12, replace=False) if i % 2 else 300 + rng.choice(30, 12, replace=False)) for i in range(3000)]
    flat, lengths = np.concatenate(rows), np.full(3000, 12)
    weight = rng.integers(1, 9000, 330)
    value = rng.integers(1, 1_000_000, len(flat))
    want = {i: int(sum(weight[t] * v for t, v in zip(r, value[12 * i:12 * i + 12], strict=True) if t in range(300, 312))) for i, r in enumerate(rows)}
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    tree = balltree.BallTree(np.arange(3000), np.zeros(3000, bool), offsets, flat.copy(), value.copy(), weight)
    for node, (start, end) in enumerate(tree.spans):  # every document lies within its nodes' balls
        c = tree.centres[node].astype(float)
        for i in range(start, end, 37):
            x = np.zeros(330)
            own = tree.terms[tree.offsets[i]:tree.offsets[i + 1]]
            x[own] = tree.values[tree.offsets[i]:tree.offsets[i + 1]] * tree.root[own]
            assert all(np.linalg.norm((x - c)[tree.group == g]) <= tree.radii[node][g] for g in range(tree.groups))
    best, item = balltree.Best(), np.arange(300, 312)
    leaves = sum(not c for c in tree.children)
    assert tree.search(item, weight[item], best, np.zeros(330, np.int64)) < leaves  # the other half is pruned
    assert best.scores.tolist() == sorted(want.values(), reverse=True)[:50]

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from placemill.operators import linkage
from test_nearest import metres, usable

WORDS = ["Akatsuki", "akatuki", "Shop", "shap", "セブン", "セブソ", "店", "本店", "a", "ab", "xyz", "東京 駅前", "東京駅前", "", "  ", "é", "12", "13"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(name):
    return "".join((name or "").split()).lower()


def records(rng, n, spread):
    out = []
    for i in range(n):
        name = " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3)))
        out.append((i, None if rng.random() < 0.03 else name, 135 + rng.uniform(0, spread), 35 + rng.uniform(0, spread)))
    return out + [(n, "Shop", None, 35.0), (n + 1, "Shop", math.nan, 35.0), (n + 2, "", 135.0, 35.0)]


SCHEMA = "id int, name string, lon double, lat double"


@pytest.mark.parametrize("edits", [0, 2, 3])
def test_pairs_equal_brute_force(spark, edits):
    rng = random.Random(edits)
    left, right = records(rng, 120, 0.03), records(rng, 120, 0.03)
    want = {}
    for i, n, *p in left:
        for j, m, *q in right:
            if plain(n) and plain(m) and usable(p) and usable(q) and metres(p, q) <= 900.0 and (e := distance(plain(n), plain(m))) <= edits:
                want[(i, j)] = (e, metres(p, q))
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    got = {(r[0], r[1]): (r[2], round(r[3], 6)) for r in linkage.fuzzy_pairs(a, b, 900.0, edits).collect()}
    assert got == want and len(want) > 20
    best = {}
    for (i, j), (e, d) in want.items():
        best[i] = min(best.get(i, (99,)), (e, round(d, 3), j))
    assert {r[0]: (r[2], r[3], r[1]) for r in linkage.fuzzy_link(a, b, 900.0, edits).collect()} == best


def test_crowded_cell_meets_by_grams_only(spark, no_broadcast):
    """A thousand shops on one spot, alike in nothing but their place, hardly meet; the join can be split."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, "".join(rng.choice(letters) for _ in range(14)), 135.0, 35.0) for i in range(1000)]
    left = spark.createDataFrame(rows, SCHEMA)
    right = spark.createDataFrame([(i, n[:-1] + "#", x, y) for i, n, x, y in rows], SCHEMA)
    out = linkage.fuzzy_pairs(left, right, 100.0, 2)
    plan = plan_of(out)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    counts = linkage.gram_counts(left.select(linkage.comparable(F.col("name")).alias("_name")))
    prefix = left.select("id", F.inline(linkage.prefix_grams(F.col("name"), 2, counts)))
    met = prefix.join(prefix.select(F.col("id").alias("other"), "gram"), "gram").where("id <> other").count()
    assert met < 1000 * 1000 / 10  # of a million pairs that the cell alone would make
    assert {(r[0], r[1]) for r in out.collect()} == {(i, i) for i in range(1000)}


def test_no_rows(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a", 1.0, 1.0)], SCHEMA)
    assert linkage.fuzzy_link(none, one, 10.0, 1).count() == 0 and linkage.fuzzy_link(one, none, 10.0, 1).count() == 0


def test_best_link_of_records_that_share_an_id_or_have_none(spark):
    left = spark.createDataFrame([(1, "abcdef", 135.0, 35.0), (1, "abcdeg", 135.0, 35.0), (None, "abcdef", 135.0, 35.0), (2, "qwertz", 135.0, 35.0)], SCHEMA)
    right = spark.createDataFrame([(7, "abcdeg", 135.001, 35.0), (8, "abcdef", 135.002, 35.0), (9, "qwertx", 135.0, 35.005), (6, "qwertx", 135.0, 35.005)], SCHEMA)
    got = {r[0]: tuple(r)[1:3] for r in linkage.fuzzy_link(left, right, 900.0, 2).collect()}
    assert got == {1: (7, 0), None: (8, 0), 2: (6, 1)}


def test_linked_records_do_not_meet_again(spark, monkeypatch):
    """Records with a link of equal name are out of the steps that meet by grams."""
    sizes, pairs = [], linkage._pairs
    monkeypatch.setattr(linkage, "_pairs", lambda a, *rest: (sizes.append(a.count()), pairs(a, *rest))[1])
    rows = [(i, f"shop {i:04d}", 135.0, 35.0) for i in range(100)]
    right = [(i, n + (" #" if i % 10 == 0 else ""), x, y) for i, n, x, y in rows]
    got = linkage.fuzzy_link(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(right, SCHEMA), 100.0, 2).collect()
    assert len(got) == 100 and sizes == [100, 10]

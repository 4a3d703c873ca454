import random

from conftest import plan_of
from placemill.operators import gazetteer as g

PLACES = [("東京都", "港区"), ("東京都", "府中市"), ("広島県", "府中市"), ("広島県", "府中町"), ("北海道", "札幌市"), ("北海道", "札幌市 中央区"), ("X", "A"), ("X", "A B"), (None, "無県町")]


def frame(spark, rows=PLACES):
    return spark.createDataFrame(rows, "prefecture string, municipality string")


def brute(address):
    text = "".join((address or "").split())
    names = {}
    for p, m in PLACES:
        for key in {"".join(((p or "") + m).split()), "".join(m.split())}:
            names.setdefault(key, []).append((p, m))
    fits = [k for k in names if len(names[k]) == 1 and text.startswith(k)]
    return names[max(fits, key=len)][0] if fits else (None, None)


def test_longest_prefix(spark, no_broadcast):
    rng = random.Random(2)
    bits = ["東京都", "広島県", "北海道", "港区", "府中市", "府中町", "札幌市", "中央区", "A", "B", " ", "　", "1-2-3", "無県町", "X"]
    addresses = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 5))) for _ in range(400)] + [None, "", "府中市1", "東京都府中市1"] + ["港区1"] * 300
    rows = spark.createDataFrame(list(enumerate(addresses)), "id int, address string")
    out = g.municipality_of_address(rows, frame(spark))
    got = {r.id: (r.found_prefecture, r.found_municipality) for r in out.collect()}
    assert got == {i: brute(a) for i, a in enumerate(addresses)}
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)


def test_coverage_and_gaps(spark):
    located = spark.createDataFrame([("東京都", "港区"), ("東京都", "港区"), ("広島県", "府中町"), (None, None), (None, "無県町")],
                                    "found_prefecture string, found_municipality string")
    rows = {(r.level, r.prefecture, r.municipality): (r.n_rows, r.n_municipalities, r.n_covered) for r in g.coverage_by_level(located, frame(spark)).collect()}
    assert rows[("country", None, None)] == (4, 9, 3)
    assert rows[("prefecture", "東京都", None)] == (2, 2, 1) and rows[("prefecture", "北海道", None)] == (0, 2, 0)
    assert rows[("municipality", "広島県", "府中町")] == (1, 1, 1) and rows[("municipality", "東京都", "府中市")] == (0, 1, 0)
    gaps = {(r.prefecture, r.municipality) for r in g.coverage_gaps(located, frame(spark)).collect()}
    assert gaps == set(PLACES) - {("東京都", "港区"), ("広島県", "府中町"), (None, "無県町")}


def test_empty(spark):
    rows = spark.createDataFrame([(1, "港区")], "id int, address string")
    assert g.municipality_of_address(rows, frame(spark, [])).first().found_municipality is None
    assert g.municipality_of_address(rows.where("false"), frame(spark)).count() == 0

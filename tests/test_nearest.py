import math
import random

import pytest

from placemill.operators.nearest import nearest_neighbours, rings


def metres(a, b):
    return round(math.sqrt(((b[0] - a[0]) * 111320.0 * math.cos(math.radians(a[1]))) ** 2 + ((b[1] - a[1]) * 110540.0) ** 2), 6)


def usable(p):
    return None not in p and not any(math.isnan(v) or math.isinf(v) for v in p)


def check(spark, left, right, widest, k, on=("key",)):
    rows = spark.createDataFrame([(i, key, *p) for i, (key, p) in enumerate(left)], "id int, key string, lon double, lat double")
    partners = spark.createDataFrame([(i, key, *p) for i, (key, p) in enumerate(right)], "id int, key string, lon double, lat double")
    got = {r.id: [(n.metres, n.id) for n in r.neighbours] for r in nearest_neighbours(rows, partners, widest, k, list(on)).collect()}
    want = {}
    for i, (key, p) in enumerate(left):
        near = []
        if usable(p) and (not on or key is not None):
            near = [(metres(p, q), j) for j, (other, q) in enumerate(right) if usable(q) and (not on or key == other)]
        want[i] = sorted(n for n in near if n[0] <= widest)[:k]
    assert got == want


def cloud(rng, n, lon, lat, spread, keys=("a", "b", None)):
    return [(rng.choice(keys), (lon + rng.uniform(-spread, spread), lat + rng.uniform(-spread, spread))) for _ in range(n)]


@pytest.mark.parametrize("lon,lat,k", [(135.0, 35.0, 1), (0.0, 0.0, 3), (20.0, 69.0, 3), (-70.0, -33.0, 1)])
def test_equals_brute_force(spark, lon, lat, k):
    rng = random.Random(f"{lon}{k}")
    left = cloud(rng, 150, lon, lat, 0.02) + cloud(rng, 40, lon, lat, 0.0003)
    right = cloud(rng, 100, lon, lat, 0.03) + cloud(rng, 60, lon, lat, 0.0005)
    right += [right[0]] * 5 + [right[-1]] * 5  # repeated spots
    odd = [("a", (None, 35.0)), ("a", (float("nan"), 1.0)), ("a", (float("inf"), 1.0)), (None, (lon, lat))]
    check(spark, left + odd + left[:3], right + odd, 1500.0, k)


def test_without_keys_and_without_partners(spark):
    rng = random.Random(1)
    check(spark, cloud(rng, 60, 10.0, 50.0, 0.01), cloud(rng, 40, 10.0, 50.0, 0.01), 600.0, 2, ())
    check(spark, cloud(rng, 5, 10.0, 50.0, 0.01), [], 600.0, 1)
    check(spark, [], cloud(rng, 5, 10.0, 50.0, 0.01), 600.0, 1)


def test_rings_end_at_the_widest():
    assert rings(30.0) == [30.0] and rings(500.0) == [50.0, 250.0, 500.0]
    assert len(rings(1e6)) < 10


def test_crowded_spots_join_once(spark):
    """Many rows and partners at one spot are one spot each."""
    rows = [("a", (135.0, 35.0))] * 2000 + [("a", (135.001, 35.0))]
    check(spark, rows, [("a", (135.0, 35.0))] * 2000, 500.0, 2)

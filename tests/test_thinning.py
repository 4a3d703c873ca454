import math
import random
from collections import Counter

from pyspark.sql import functions as F

from placemill.operators import thinning as t


def cell(lon, lat, zoom):
    n = 1 << zoom
    y = (1 - math.log(math.tan(math.radians(lat)) + 1 / math.cos(math.radians(lat))) / math.pi) / 2
    return int((lon + 180) / 360 * n), int(y * n)


def curve(x, y):
    return sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(t.CURVE_ZOOM))


def brute(points, per_tile, max_zoom):
    line = sorted((curve(*cell(x, y, t.CURVE_ZOOM)), i, x, y) for i, x, y in points)
    sparse = {}
    for k, (c, i, x, y) in enumerate(line):
        sparse[i] = (t.SPARSEST if k == 0 else (c - line[k - 1][0]).bit_length(), x, y)
    out = set()
    for z in range(max_zoom + 1):
        tile = {i: tuple(v >> (max_zoom - z) for v in cell(x, y, max_zoom)) for i, (_, x, y) in sparse.items()}
        for threshold in range(t.SPARSEST + 1):
            kept = [i for i, (s, *_) in sparse.items() if s >= threshold]
            if threshold == t.SPARSEST or max(Counter(tile[i] for i in kept).values(), default=0) <= per_tile:
                break
        out |= {(z, *tile[i], i) for i in kept}
    return out


def test_equals_brute_force(spark):
    rng = random.Random(4)
    points = [(i, rng.uniform(139, 140), rng.uniform(35, 36)) for i in range(300)]
    points += [(1000 + i, 139.5 + rng.gauss(0, 0.002), 35.5 + rng.gauss(0, 0.002)) for i in range(300)]
    points += [(2000 + i, 139.25, 35.25) for i in range(40)]  # one spot
    rows = spark.createDataFrame([*points, (5000, None, 35.0), (5001, math.nan, 35.0)], "id int, lon double, lat double").repartition(7)
    for per_tile in (1, 8):
        got = t.drop_densest(rows, per_tile, 9)
        assert got.columns == ["z", "x", "y", "id", "lon", "lat"]
        assert {(r.z, r.x, r.y, r.id) for r in got.collect()} == brute(points, per_tile, 9)


def test_curve(spark):
    rows = [(x, y) for x in (0, 1, 5, 65535, 40000) for y in (0, 2, 65535, 12345)]
    got = spark.createDataFrame(rows, "x long, y long").select("x", "y", t.z_order(F.col("x"), F.col("y")).alias("c")).collect()
    assert all(r.c == curve(r.x, r.y) for r in got)


def test_no_points(spark):
    assert t.drop_densest(spark.createDataFrame([], "id int, lon double, lat double"), 5, 3).count() == 0

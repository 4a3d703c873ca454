import math
import random
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from placemill.functions.geo import Degrees, Metres
from placemill.operators.proximity import having_neighbour, without_neighbour


def near(metric, a, b):
    if None in (*a, *b) or any(math.isnan(v) for v in (*a, *b)):
        return False
    if isinstance(metric, Degrees):
        return (b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2 <= metric.radius ** 2
    return math.sqrt(((b[0] - a[0]) * 111320.0 * math.cos(math.radians(a[1]))) ** 2
                     + ((b[1] - a[1]) * 110540.0) ** 2) <= metric.radius


def check(spark, metric, left, right, on=()):
    rows = spark.createDataFrame([(i, k, *p) for i, (k, p) in enumerate(left)], "id int, k string, lon double, lat double")
    partners = spark.createDataFrame([(k, *p) for k, p in right], "k string, lon double, lat double")
    want = {i for i, (k, p) in enumerate(left)
            if any((not on or (k is not None and k == kr)) and near(metric, p, q) for kr, q in right)}
    got = [r.id for r in having_neighbour(rows, partners, metric, on).collect()]
    rest = [r.id for r in without_neighbour(rows, partners, metric, on).collect()]
    assert sorted(got) == sorted(want)
    assert sorted(rest) == sorted(set(range(len(left))) - want)


def cloud(rng, n, lon, lat, spread, keys=("a", "b", None)):
    return [(rng.choice(keys), (lon + rng.uniform(-spread, spread), lat + rng.uniform(-spread, spread))) for _ in range(n)]


@pytest.mark.parametrize("metric,spread,lon,lat", [
    (Metres(50.0), 0.003, 135.0, 35.0), (Metres(50.0), 0.003, 0.0, 0.0), (Metres(50.0), 0.003, 20.0, 69.0),
    (Metres(500.0), 0.02, -70.0, -33.0), (Degrees(0.0011), 0.008, 179.9, 45.8), (Degrees(0.0011), 0.008, 0.0, 0.0),
])
def test_equals_brute_force(spark, metric, spread, lon, lat):
    rng = random.Random(f"{metric}{lon}{lat}")
    left, right = cloud(rng, 300, lon, lat, spread), cloud(rng, 250, lon, lat, spread)
    check(spark, metric, left, right, ("k",))
    check(spark, metric, left, right)


@pytest.mark.parametrize("metric", [Metres(50.0), Degrees(0.0011)])
def test_crowded_cell_of_continuous_coordinates(spark, metric):
    rng = random.Random(str(metric))
    left = cloud(rng, 300, 135.0, 35.0, 0.003) + [(None, (None, 1.0)), ("a", (float("nan"), 1.0)), ("a", (135.0, 35.0))]
    right = cloud(rng, 100, 135.0, 35.0, 0.003) + [("a", (135.0 + rng.uniform(0, 1e-4), 35.0 + rng.uniform(0, 1e-4))) for _ in range(2000)]
    check(spark, metric, left, right, ("k",))


def test_planar_coordinates_beyond_a_million(spark):
    far = [("a", (2e6, 2e6)), ("a", (-3e9, 5e7)), ("a", (float("inf"), 0.0))]
    check(spark, Degrees(10.0), far, [("a", (2e6 + 6, 2e6 + 8)), ("a", (-3e9, 5e7 + 11)), ("a", (float("inf"), 0.0))])


def test_near_the_pole(spark):
    rng = random.Random(7)
    wide = lambda n: [("a", (rng.uniform(-180, 180), 89.99 + rng.uniform(-0.01, 0.0099))) for _ in range(n)]
    check(spark, Metres(300.0), wide(150), wide(150))


coordinate = st.integers(-40, 40).map(lambda i: i * 0.00011)
point = st.tuples(st.sampled_from("ab"), st.tuples(coordinate.map(lambda x: 135 + x), coordinate.map(lambda y: 36 + y)))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(point, min_size=1, max_size=40), st.lists(point, min_size=1, max_size=40))
def test_lattice_points(spark, left, right):
    check(spark, Metres(50.0), left, right, ("k",))


def test_unusable_coordinates_have_no_neighbour(spark):
    odd = [("a", p) for p in ((None, 35.0), (135.0, None), (float("nan"), 35.0), (0.0, float("nan")), (None, None))]
    check(spark, Degrees(0.0011), [*odd, ("a", (0.0, 0.0))], [*odd, ("a", (0.0, 0.001))])


def test_radius_is_inclusive(spark):
    check(spark, Degrees(0.5), [("a", (10.0, 10.0))], [("a", (10.5, 10.0))])
    rows = spark.createDataFrame([(10.0, 10.0)], "lon double, lat double")
    at = lambda lon, lat: spark.createDataFrame([(lon, lat)], "lon double, lat double")
    assert having_neighbour(rows, at(10.5, 10.0), Degrees(0.5)).count() == 1
    assert having_neighbour(rows, at(10.5000001, 10.0), Degrees(0.5)).count() == 0
    assert having_neighbour(rows, at(10.0, 9.5), Degrees(0.5)).count() == 1


def test_distance_is_scaled_at_the_row_not_the_partner(spark):
    rows = spark.createDataFrame([(10.0, 60.0)], "lon double, lat double")
    partner = spark.createDataFrame([(10.0 + 50 / (111320.0 * math.cos(math.radians(60.0001))), 60.0001)], "lon double, lat double")
    back = having_neighbour(partner, rows, Metres(51.2))
    for a, b, out in ((rows, partner, having_neighbour(rows, partner, Metres(51.2))), (partner, rows, back)):
        p, q = (tuple(x.first()) for x in (a, b))
        assert out.count() == int(near(Metres(51.2), p, q))


def test_partners_are_copied_to_nine_cells_at_most(spark):
    """On random doubles, and only to cells that hold a probing row."""
    from placemill.functions.geo import SearchGrid
    from placemill.operators.proximity import candidate_copies

    rng = random.Random(3)
    spots = spark.createDataFrame([(135 + rng.uniform(0, 0.02), 35 + rng.uniform(0, 0.02)) for _ in range(3000)], "_plon double, _plat double")
    wide = SearchGrid(Metres(50.0), 1.0)
    row = wide.row(F.col("_plat"))
    cells = spots.select(row.alias("_wy"), wide.column(F.col("_plon"), row).alias("_wx"))
    around = [cells.select((F.col("_wy") + dy).alias("_wy"), (F.col("_wx") + dx).alias("_wx")) for dx in range(-3, 4) for dy in range(-3, 4)]
    every = reduce(lambda a, b: a.unionByName(b), around).distinct()
    assert candidate_copies(spots, every, wide, []).count() <= 9.2 * 3000  # a spot may touch the rim of one cell more
    few = cells.where("_wx % 7 = 0").distinct()
    assert candidate_copies(spots, few, wide, []).count() < 9.2 * 3000 / 4


def test_no_job_before_the_action(spark):
    from placemill.plans.master import candidates
    from placemill_checks import frames

    sf = "/root/testdata/sf0.001"
    places, tagged = frames.places(spark, sf), frames.community(spark, sf)
    spark.sparkContext.setJobGroup("planning", "planning")
    rows = candidates(places, tagged)
    having_neighbour(rows, rows, Metres(50.0))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_plan_has_no_nested_loop(spark, no_broadcast):
    rows = spark.createDataFrame([("a", 1.0, 2.0)], "k string, lon double, lat double")
    for join in (having_neighbour, without_neighbour):
        plan = plan_of(join(rows, rows, Metres(50.0), ["k"]))
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_crowded_probe_cell_is_split(spark, no_broadcast):
    """Most of the probing rows in one cell: adaptive execution divides that partition."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    i = F.col("id")
    rows = spark.range(0, 60000, 1, 6).select("id", F.when(i % 10 > 0, 135.0 + i * 1e-12).otherwise(130.0 + i * 0.0001).alias("lon"),
                                              F.when(i % 10 > 0, 35.0).otherwise(30.0 + i * 0.0001).alias("lat"))
    partners = spark.range(0, 3000, 1, 2).select((130.0 + i * 0.002).alias("lon"), (30.0 + i * 0.002).alias("lat"))
    try:
        for join in (having_neighbour, without_neighbour):
            out = join(rows, partners, Metres(50.0))
            out.write.format("noop").mode("overwrite").save()
            out.collect()
            assert "SortMergeJoin(skew=true)" in plan_of(out)
    finally:
        for k in settings:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")

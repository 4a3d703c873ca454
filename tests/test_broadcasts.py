"""Joins both sides of which grow with the data broadcast neither, however small their files are."""

import pytest
from pyspark.sql import functions as F

from placemill.functions.geo import Metres
from placemill.operators import linkage
from placemill.operators.nearest import nearest_neighbours
from placemill.operators.proximity import having_neighbour, without_neighbour
from placemill.operators.regions import assign_region, build_region_index, tally_regions
from placemill.sources.places import ring_edges
from tests.conftest import plan_of


@pytest.fixture
def shops(spark, tmp_path):
    path = str(tmp_path / "shops")
    i = F.col("id")
    spark.range(50).select("id", F.concat(F.lit("shop "), i.cast("string")).alias("name"), (130 + i * 0.001).alias("lon"), (i * 0.0 + 35.0).alias("lat")).write.parquet(path)
    return spark.read.parquet(path)


def diamonds(shops):
    corner = lambda x, y: F.array(F.col("lon") + x, F.col("lat") + y)
    ring = F.array(corner(-0.01, 0.0), corner(0.0, -0.01), corner(0.01, 0.0), corner(0.0, 0.01), corner(-0.01, 0.0))
    return build_region_index(ring_edges(shops.select(F.col("name").alias("pref"), F.array(ring).alias("rings"))))


@pytest.mark.parametrize("how", [assign_region, tally_regions])
def test_points_and_region_cells(shops, how):
    found = how(shops.select("id", "lon", "lat"), diamonds(shops))
    assert "Broadcast" not in plan_of(found) and found.count() > 50
    assert "Broadcast" not in plan_of(found)  # as adaptive execution has left it


def test_neighbours(shops):
    for found in (having_neighbour(shops, shops, Metres(50.0)), without_neighbour(shops, shops, Metres(50.0)), nearest_neighbours(shops, shops, 300.0, 3)):
        assert found.count() in (50, 0) and "Broadcast" not in plan_of(found)


def test_links(shops):
    found = linkage.fuzzy_pairs(shops, shops, 500.0, 1)
    assert "Broadcast" not in plan_of(found)

"""The food-shop master: category rules, cross-source duplicates, region, id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill import vocab
from placemill.functions.classify import is_noise
from placemill.functions.geo import Degrees, Metres, parse_degrees
from placemill.operators.numbering import number_rows
from placemill.plans.accounting import RowCounts
from placemill.operators.proximity import without_neighbour
from placemill.operators.regions import assign_region, build_region_index

CANDIDATE = ("cat", "name", "brand", "src", "lon", "lat")
MASTER = ("cat", "name", "brand", "src", "prefecture", "lat", "lng")
NEAR = Degrees(vocab.DUPLICATE_DEGREES)


def of_category(places: DataFrame, cat: str, *categories: str) -> DataFrame:
    """Candidates of the main source with constant tags."""
    return places.where(F.col("category").isin(*categories)).select(
        F.lit(cat).alias("cat"), "name", F.col("brand_name").alias("brand"),
        F.lit("overture").alias("src"), "lon", "lat",
    )


def clean_groceries(places: DataFrame) -> DataFrame:
    """Grocery records that are neither food service nor general goods; NULL names drop."""
    return places.where((F.col("category") == "grocery_store") & ~is_noise(F.col("name"), F.col("category_alt")))


def unique_groceries(places: DataFrame, near: Degrees | Metres = NEAR) -> DataFrame:
    """Clean groceries, counted as supermarkets, that no supermarket record is near to."""
    groceries = of_category(clean_groceries(places), "supermarket", "grocery_store")
    return without_neighbour(groceries, of_category(places, "supermarket", "supermarket"), near)


def community_fresh(tagged: DataFrame) -> DataFrame:
    """Fresh-food shops of the community source; tags are case-sensitive here. Bad coordinates become NULL."""
    return tagged.where(F.col("shop").isin(*vocab.FRESH_SHOP_TAGS)).select(
        F.lit("fresh_food").alias("cat"), "name", F.lit(None).cast("string").alias("brand"),
        F.lit("osm").alias("src"),
        parse_degrees(F.col("`@lon`")).alias("lon"), parse_degrees(F.col("`@lat`")).alias("lat"),
    )


def unique_community_fresh(places: DataFrame, tagged: DataFrame, near: Degrees | Metres = NEAR) -> DataFrame:
    """Community fresh-food shops that no main-source fresh-food record is near to."""
    main = of_category(places, "fresh_food", *vocab.FRESH_PLACE_CATEGORIES)
    return without_neighbour(community_fresh(tagged), main, near)


def candidates(places: DataFrame, tagged: DataFrame, near: Degrees | Metres = NEAR) -> DataFrame:
    """All candidate shops before region assignment."""
    as_is = places.where(F.col("category").isin(
        "supermarket", "convenience_store", "drugstore", *vocab.FRESH_PLACE_CATEGORIES))
    cat = (
        F.when(F.col("category") == "supermarket", "supermarket")
        .when(F.col("category") == "convenience_store", "convenience")
        .when(F.col("category") == "drugstore", "drugstore").otherwise("fresh_food")
    )
    direct = as_is.select(cat.alias("cat"), "name", F.col("brand_name").alias("brand"),
                          F.lit("overture").alias("src"), "lon", "lat")
    parts = [direct, unique_groceries(places, near), unique_community_fresh(places, tagged, near)]
    return reduce(DataFrame.unionByName, [p.select(*CANDIDATE) for p in parts])


def locate(cand: DataFrame, region_edges: DataFrame) -> DataFrame:
    """Candidates inside a region, in master columns but without id."""
    return assign_region(cand, build_region_index(region_edges)).select(
        "cat", "name", "brand", "src", F.col("pref").alias("prefecture"), "lat", F.col("lon").alias("lng")
    )


def build_master(places: DataFrame, tagged: DataFrame, region_edges: DataFrame,
                 near: Degrees | Metres = NEAR, ordered: bool = True, counted: RowCounts | None = None) -> DataFrame:
    """The master table. Ids follow category, source, region and position; ``ordered=False`` skips that sort. Rows are written
    once to be numbered; ``counted`` gets the row accounting of that very pass."""
    cand = candidates(places, tagged, near)
    located = locate(counted.before(cand) if counted else cand, region_edges)
    if counted:
        located = counted.after(located)
    order = ("cat", "src", "prefecture", "lng", "lat", "name", "brand") if ordered else ()
    return number_rows(located, "store_id", order)

"""Rows shaped for maps: GeoJSON features and information cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill import vocab
from placemill.functions.classify import category_bucket


def geojson_features(places: DataFrame) -> DataFrame:
    """One GeoJSON feature per place with coordinates; NULL properties are written as null."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
        F.struct(
            "name", category_bucket(F.col("category")).alias("cat"), F.col("category").alias("cat_raw"), "confidence"
        ).alias("properties"),
    )
    located = places.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    return located.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


def two_decimals(value: Column) -> Column:
    """A number with two decimals, rounded by its exact binary value; of two equally near texts the larger one.

    The number is split in two halves whose products with 100 are exact, so the distance to the midpoint is, too.
    """
    wide = value * F.lit(float((1 << 27) + 1))
    high = wide - (wide - value)
    low = value - high
    below = F.floor(value * 100)
    over = (high * 100 - (below + F.lit(0.5))) + low * 100
    return F.when(value.isNotNull(), F.format_string("%.2f", F.when(over >= 0, below + 1).otherwise(below) / F.lit(100.0)))


def in_bucket(rows: DataFrame, cat: str) -> DataFrame:
    """The interactive selection: 'all' keeps everything."""
    return rows if cat == "all" else rows.where(F.col("cat") == cat)


def place_cards(places: DataFrame, cat: str = "all", no_name: str = vocab.NO_NAME) -> DataFrame:
    """Title, category and confidence text as shown for a selected place."""
    rows = places.withColumn("cat", category_bucket(F.col("category")))
    return in_bucket(rows, cat).select(
        "id", "cat",
        F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit(no_name)).alias("title"),
        F.coalesce(F.nullif(F.col("category"), F.lit("")), F.col("cat")).alias("category"),
        two_decimals(F.col("confidence")).alias("confidence"),
    )

"""Municipalities of register rows by the longest gazetteer name that an address begins with, and how far a register covers them.

A gazetteer is a frame (prefecture, municipality). An address may begin with the municipality or with the prefecture before it,
with or without white space in between; addresses and names are compared without white space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.functions.text import squeeze_out


def gazetteer_names(gazetteer: DataFrame) -> DataFrame:
    """(prefix, prefecture, municipality): what addresses may begin with. A municipality name that several prefectures have is
    only known with its prefecture before it."""
    known = gazetteer.select("prefecture", "municipality").where(squeeze_out(F.col("municipality")) != "").distinct()
    full = F.concat(squeeze_out(F.coalesce("prefecture", F.lit(""))), squeeze_out(F.col("municipality")))
    names = known.select(F.explode(F.array_distinct(F.array(full, squeeze_out(F.col("municipality"))))).alias("prefix"), "prefecture", "municipality")
    only = names.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.first("prefecture").alias("prefecture"), F.first("municipality").alias("municipality"))
    return only.where("n = 1").drop("n")


def municipality_of_address(rows: DataFrame, gazetteer: DataFrame, address: str = "address") -> DataFrame:
    """The rows with ``found_prefecture`` and ``found_municipality``, NULL if no name fits.

    Distinct addresses are cut to the lengths that names have and joined by equality; the longest name wins by one aggregate
    with map-side combine. The lengths are a list as long as the longest name at most.
    """
    names = gazetteer_names(gazetteer)
    lengths = sorted(r["n"] for r in names.select(F.char_length("prefix").alias("n")).distinct().collect())
    text = squeeze_out(F.coalesce(F.col(address).cast("string"), F.lit("")))
    begun = rows.select(text.alias("_text")).distinct().select(
        "_text", F.explode(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.char_length("_text"))).alias("_n"))
    begun = begun.withColumn("prefix", F.substring("_text", F.lit(1), F.col("_n")))
    longest = F.max(F.struct("_n", "prefecture", "municipality")).alias("m")
    found = begun.join(names, "prefix").groupBy("_text").agg(longest).select(
        F.col("_text").alias("_found"), F.col("m.prefecture").alias("found_prefecture"), F.col("m.municipality").alias("found_municipality"))
    return rows.join(found, text == F.col("_found"), "left").drop("_found")


def _tallied(located: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Every municipality with the number of its rows."""
    counts = located.where("found_municipality IS NOT NULL").groupBy("found_prefecture", "found_municipality").agg(F.count(F.lit(1)).alias("n"))
    known = gazetteer.select("prefecture", "municipality").distinct()
    same = F.col("prefecture").eqNullSafe(F.col("found_prefecture")) & (F.col("municipality") == F.col("found_municipality"))
    return known.join(counts, same, "left").select("prefecture", "municipality", F.coalesce("n", F.lit(0)).alias("n"))


def coverage_by_level(located: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Rows and covered municipalities for each municipality, each prefecture and the country: (level, prefecture, municipality,
    n_rows, n_municipalities, n_covered, covered_pct). Levels come from one pass of grouping sets over the tallied gazetteer."""
    level = F.grouping_id()
    return _tallied(located, gazetteer).rollup("prefecture", "municipality").agg(
        level.alias("_level"), F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_municipalities"), F.count_if(F.col("n") > 0).alias("n_covered"),
    ).select(
        F.when(F.col("_level") == 3, "country").when(F.col("_level") == 1, "prefecture").otherwise("municipality").alias("level"),
        "prefecture", "municipality", "n_rows", "n_municipalities", "n_covered",
        F.round(F.col("n_covered") / F.col("n_municipalities") * 100, 4).alias("covered_pct"))


def coverage_gaps(located: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(prefecture, municipality) of the gazetteer without any row."""
    known = gazetteer.select("prefecture", "municipality").distinct()
    seen = located.select("found_prefecture", "found_municipality").where("found_municipality IS NOT NULL")
    same = F.col("prefecture").eqNullSafe(F.col("found_prefecture")) & (F.col("municipality") == F.col("found_municipality"))
    return known.join(seen, same, "left_anti")

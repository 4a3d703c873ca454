"""Generic-name records that repeat a nearby branch of the same chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill import vocab
from placemill.functions.classify import chain_or_other, is_branded
from placemill.functions.geo import Metres
from placemill.operators.nearest import nearest_neighbours
from placemill.operators.proximity import having_neighbour


def with_chain_and_branch(places: DataFrame, category: str = "convenience_store") -> DataFrame:
    """id, lon, lat, chain, branded of one category; branded is NULL for a NULL name."""
    return places.where(F.col("category") == category).select(
        "id", "lon", "lat", chain_or_other(F.col("name")).alias("chain"), is_branded(F.col("name")).alias("branded")
    )


def near_branches(shops: DataFrame, radius_m: float) -> DataFrame:
    """Generic shops with a branded shop of their chain within the radius."""
    return having_neighbour(shops.where(~F.col("branded")), shops.where("branded"), Metres(radius_m), on=["chain"])


def flag_duplicates(shops: DataFrame, radius_m: float = vocab.DUPLICATE_METRES) -> DataFrame:
    """All shops with ``is_duplicate``: generic, and its id is that of a near-branch record."""
    ids = near_branches(shops, radius_m).select("id").distinct().withColumn("_hit", F.lit(True))
    return shops.join(ids, "id", "left").withColumn(
        "is_duplicate", F.coalesce(~F.col("branded") & F.col("_hit"), F.lit(False))
    ).drop("_hit")


def duplicate_report(places: DataFrame, radius_m: float = vocab.DUPLICATE_METRES) -> DataFrame:
    """Per chain and in total (NULL chain): branded, generic, duplicates, isolated, rows left.

    Rows are counted per chain first; the roll-up then runs over those few counts.
    """
    shops = with_chain_and_branch(places)
    per_chain = flag_duplicates(shops, radius_m).groupBy("chain").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("branded").alias("branded"),
        F.count_if(~F.col("branded")).alias("generic"),
        F.count_if("is_duplicate").alias("near_duplicate"),
    )
    totals = [F.sum(c).alias(c) for c in ("n", "branded", "generic", "near_duplicate")]
    return (
        per_chain.rollup("chain").agg(*totals)
        .select(
            "chain", "branded", "generic", "near_duplicate",
            (F.col("generic") - F.col("near_duplicate")).alias("isolated"),
            (F.col("n") - F.col("near_duplicate")).alias("rows_after"),
        )
        .orderBy(F.col("rows_after").desc_nulls_first(), F.col("chain").asc_nulls_first())
    )


def nearest_branches(shops: DataFrame, widest_m: float) -> DataFrame:
    """(id, chain, other_id, metres): every generic shop with the nearest branded shop of its chain, NULL if there is none so near."""
    found = nearest_neighbours(shops.where(~F.col("branded")), shops.where("branded"), widest_m, on=["chain"])
    nearest = F.get("neighbours", F.lit(0))
    return found.select("id", "chain", nearest["id"].alias("other_id"), nearest["metres"].alias("metres"))


def capture_rate(places: DataFrame, radii_m: Sequence[float] = (50.0, 500.0)) -> DataFrame:
    """Share of generic shops with a branded neighbour of their chain, per radius.

    All radii are counted from the nearest branch's distance, which is found once.
    """
    nearest = nearest_branches(with_chain_and_branch(places), max(radii_m))
    counts = nearest.groupBy("chain").agg(
        F.count(F.lit(1)).alias("n_generic"), F.array(*[F.count_if(F.col("metres") <= r) for r in radii_m]).alias("captured"))
    spine = F.array(*[F.struct(F.lit(float(r)).alias("radius_m"), F.get("captured", F.lit(i)).alias("n_captured")) for i, r in enumerate(radii_m)])
    return counts.select("chain", "n_generic", F.inline(spine)).select(
        "chain", "radius_m", "n_generic", "n_captured", F.round(F.col("n_captured") / F.col("n_generic") * 100, 4).alias("capture_pct"))

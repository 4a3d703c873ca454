"""Nested place records to the flat fifteen-column table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill import vocab


def extract_places(
    raw: DataFrame,
    bbox: tuple[float, float, float, float] | None = vocab.BBOX,
    categories: Sequence[str] | None = vocab.FOOD_CATEGORIES,
    min_confidence: float | None = None,
) -> DataFrame:
    """Filter on the nested columns first, so the predicates reach the parquet scan, then flatten.

    ``sources.dataset`` is the path form of the array projection: it reads that member only.
    """
    if bbox is not None:
        west, south, east, north = bbox
        raw = raw.where(F.col("bbox.xmin").between(west, east) & F.col("bbox.ymin").between(south, north))
    if categories is not None:
        raw = raw.where(F.col("categories.primary").isin(*categories))
    if min_confidence is not None:
        raw = raw.where(F.col("confidence") >= min_confidence)
    first = F.get("addresses", F.lit(0))
    return raw.select(
        "id",
        F.col("names.primary").alias("name"),
        F.col("categories.primary").alias("category"),
        F.col("categories.alternate").alias("category_alt"),
        "confidence",
        F.col("brand.wikidata").alias("brand_wikidata"),
        F.col("brand.names.primary").alias("brand_name"),
        "operating_status",
        first["country"].alias("country"),
        first["region"].alias("region"),
        first["locality"].alias("locality"),
        first["freeform"].alias("address"),
        F.col("sources.dataset").alias("datasets"),
        F.col("bbox.xmin").alias("lon"),
        F.col("bbox.ymin").alias("lat"),
    )

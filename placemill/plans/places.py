"""From raw places to the de-duplicated layer, as one lazy plan or with the files in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placemill.operators.extract import extract_places
from placemill.operators.providers import keep_best_provider
from placemill.sinks.tables import write_parquet
from placemill.sources.places import scan_raw_places


def deduped_layer(raw: DataFrame) -> DataFrame:
    return keep_best_provider(extract_places(raw))


def extract_and_dedup(spark: SparkSession, raw_path: str, full_path: str, deduped_path: str) -> None:
    """Write the flat table and, from it, the de-duplicated layer.

    The layer is laid out by category, because everything built on it selects categories: each later scan reads
    the folders of its own categories only.
    """
    write_parquet(extract_places(scan_raw_places(spark, raw_path)), full_path)
    write_parquet(keep_best_provider(spark.read.parquet(full_path)), deduped_path, partition_by=["category"])

"""From register files to the merged register."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from placemill.operators.registers import merge_register, normalize_records
from placemill.sources.registers import scan_registers
from placemill.sources.registry import SourceSpec


def harmonised_rows(spark: SparkSession, specs: Sequence[SourceSpec] | DataFrame, folder: str | None = None) -> DataFrame:
    return normalize_records(scan_registers(spark, specs, folder), specs)


def merged_register(spark: SparkSession, specs: Sequence[SourceSpec]) -> DataFrame:
    return merge_register(harmonised_rows(spark, specs))

"""Writing a layer so that a bounding box reads few row groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.functions.geo import is_point, tile_x, tile_y
from placemill.operators.thinning import CURVE_ZOOM, z_order

GROUP_ROWS = 100_000


def curve_key(lon: Column, lat: Column) -> Column:
    """The place on a Z-shaped curve over the map; NULL without usable coordinates."""
    return F.when(is_point(lon, lat), z_order(tile_x(lon, CURVE_ZOOM), tile_y(lat, CURVE_ZOOM)))


def write_clustered(df: DataFrame, path: str, lon: Column, lat: Column, files: int | None = None, group_rows: int = GROUP_ROWS,
                    mode: str = "errorifexists") -> None:
    """Parquet in the order of a space-filling curve, in row groups of at most ``group_rows``.

    Rows are range-partitioned by the curve (and a hash of the row, so that a crowded spot can be parted), and sorted inside
    partitions. The statistics of a row group then span a small area, and a bounding box on the coordinate columns skips the others.
    """
    key, spread = "_curve", "_spread"
    keyed = df.withColumn(key, curve_key(lon, lat)).withColumn(spread, F.xxhash64(lon, lat, F.monotonically_increasing_id()))
    lined = keyed.repartitionByRange(files, key, spread) if files else keyed.repartitionByRange(key, spread)
    (
        lined.sortWithinPartitions(key, spread).drop(key, spread).write.mode(mode).option("compression", "zstd")
        .option("parquet.block.row.count.limit", str(group_rows)).parquet(path)
    )

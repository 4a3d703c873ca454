"""Thinning of a tile set by density: what lies closest to its predecessor goes first.

The rule: points are put in the order of a Z-shaped curve over the cells of zoom ``CURVE_ZOOM`` (then by id), and a point's gap is the
distance along the curve to the point before it. Its sparseness is the number of binary digits of the gap, 0 for a point in the same
cell as its predecessor; the first point is the sparsest. At each zoom the points with a sparseness of at least that zoom's
threshold stay, and the threshold is the least one with which no tile of the zoom has more than ``per_tile`` points. If even the
sparsest points are too many for some tile, they stay nevertheless: each zoom keeps at least those.

Thresholds come from counts per tile and sparseness, made at the deepest zoom and summed upwards one zoom at a time; only counts
go up. The order is one range shuffle; gaps across its partitions come from a table of one row per partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemill.operators.tiles import MAX_ZOOM, tile_index
from placemill.session import stable

CURVE_ZOOM = 16
SPARSEST = 2 * CURVE_ZOOM + 1


def _spread(c: Column) -> Column:
    """The binary digits of a number below 2^32 at every other place."""
    out = c.cast("bigint")
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(F.lit(mask))
    return out


def z_order(x: Column, y: Column) -> Column:
    """The place on the Z-shaped curve of a cell."""
    return _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))


def with_sparseness(points: DataFrame, id_col: str = "id", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The points that have usable coordinates, with ``sparseness``. ``id_col`` should be unique; equal ids may swap places."""
    placed = tile_index(points, CURVE_ZOOM, lon, lat).withColumn("_curve", z_order(F.col("x"), F.col("y"))).drop("x", "y", "z")
    lined = placed.repartitionByRange("_curve", id_col).sortWithinPartitions("_curve", id_col)
    lined = stable(lined.withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()}), "curve")
    ends = lined.groupBy("_part").agg(F.max("_curve").alias("_last"))
    before = Window.orderBy("_part").rowsBetween(-1, -1)
    # one row per partition written
    ends = ends.select("_part", F.max("_last").over(before).alias("_before"))
    previous = F.coalesce(F.lag("_curve").over(Window.partitionBy("_part").orderBy("_pos")), F.col("_before"))
    gap = F.col("_curve") - previous
    digits = F.when(gap.isNull(), SPARSEST).when(gap == 0, 0).otherwise(F.length(F.bin(gap)))
    return lined.join(F.broadcast(ends), "_part").withColumn("sparseness", digits.cast("int")).drop("_curve", "_part", "_pos", "_before")


def density_thresholds(sparse: DataFrame, per_tile: int, max_zoom: int = MAX_ZOOM, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(z, threshold) of each zoom."""
    counts = tile_index(sparse, max_zoom, lon, lat).groupBy("x", "y", "sparseness").agg(F.count(F.lit(1)).alias("n"))
    levels = []
    for z in range(max_zoom, -1, -1):
        counts = stable(counts, "tile-counts")
        more = F.sum("n").over(Window.partitionBy("x", "y").orderBy(F.desc("sparseness")))  # a row per sparseness at most
        full = counts.withColumn("more", more).where(F.col("more") > per_tile).agg(F.max("sparseness").alias("full"))
        levels.append(full.select(F.lit(z).alias("z"), F.least(F.lit(SPARSEST), F.coalesce(F.col("full") + 1, F.lit(0))).alias("threshold")))
        counts = counts.groupBy(F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y"), "sparseness").agg(F.sum("n").alias("n"))
    return reduce(DataFrame.unionAll, levels)


def drop_densest(points: DataFrame, per_tile: int, max_zoom: int = MAX_ZOOM, id_col: str = "id", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The points of each zoom that stay, with their tile: (z, x, y) and the points' columns."""
    sparse = with_sparseness(points, id_col, lon, lat)
    thresholds = stable(density_thresholds(sparse, per_tile, max_zoom, lon, lat), "thresholds")
    levels = F.array(*[F.struct(F.lit(z).alias("z"), F.col(f"_t{z}").alias("threshold")) for z in range(max_zoom + 1)])
    wide = thresholds.agg(*[F.max(F.when(F.col("z") == z, F.col("threshold"))).alias(f"_t{z}") for z in range(max_zoom + 1)])
    deepest = tile_index(sparse, max_zoom, lon, lat)
    stays = F.filter(levels, lambda t: F.col("sparseness") >= t["threshold"])
    # one row of thresholds
    zoomed = deepest.join(F.broadcast(wide), F.lit(True)).withColumn("_zooms", F.transform(stays, lambda t: t["z"])).drop(*wide.columns)
    zoomed = zoomed.withColumn("z", F.explode("_zooms"))
    shift = F.pow(F.lit(2), F.lit(max_zoom) - F.col("z")).cast("bigint")
    return zoomed.select("z", F.floor(F.col("x") / shift).alias("x"), F.floor(F.col("y") / shift).alias("y"), *points.columns)

"""Table work behind a tile set: tile indexes, counts per zoom, density thinning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemill.functions.geo import is_point, tile_x, tile_y

MAX_ZOOM = 12


def tile_index(points: DataFrame, zoom: int = MAX_ZOOM, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Points with their Web-Mercator tile; rows without usable coordinates drop out."""
    return points.where(is_point(F.col(lon), F.col(lat))).withColumns({
        "z": F.lit(zoom), "x": tile_x(F.col(lon), zoom), "y": tile_y(F.col(lat), zoom),
    })


def _ancestors(tiles: DataFrame, max_zoom: int) -> DataFrame:
    """Every tile row once per zoom 0..max_zoom, with x and y of the enclosing tile."""
    shift = F.pow(F.lit(2), F.lit(max_zoom) - F.col("z")).cast("bigint")
    return tiles.withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(max_zoom)))).withColumns({
        "x": F.floor(F.col("x") / shift).cast("bigint"), "y": F.floor(F.col("y") / shift).cast("bigint"),
    })


def tile_pyramid(points: DataFrame, max_zoom: int = MAX_ZOOM, cat: str = "cat") -> DataFrame:
    """Features per (z, x, y, cat). Points are counted at the deepest zoom; only those counts go up."""
    deepest = tile_index(points, max_zoom).groupBy("z", "x", "y", cat).agg(F.count(F.lit(1)).alias("n"))
    return _ancestors(deepest, max_zoom).groupBy("z", "x", "y", cat).agg(F.sum("n").alias("n"))


def _top(rows: DataFrame, keys: list[str], per_tile: int, order: list[Column], split: int = 64) -> DataFrame:
    """The best rows of each key. Slices of each key are ranked first, so that a crowded tile is no single task."""
    def ranked(df, by):
        window = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn("tile_rank", F.row_number().over(window)).where(F.col("tile_rank") <= per_tile)

    sliced = rows.withColumn("_slice", F.pmod(F.monotonically_increasing_id(), F.lit(split)))
    return ranked(ranked(sliced, [*keys, "_slice"]).drop("_slice"), keys)


def thin_tiles(points: DataFrame, per_tile: int, order: list[Column], max_zoom: int = MAX_ZOOM) -> DataFrame:
    """At most ``per_tile`` features per tile of each zoom, best by ``order`` (which must be total).

    A feature that is not among the best of its deepest tile cannot be among those of a larger one, so
    the deepest level is thinned first and only what is left is copied to the other zooms.
    """
    tile = ["z", "x", "y"]
    kept = _top(tile_index(points, max_zoom), tile, per_tile, order)
    return _top(_ancestors(kept, max_zoom), tile, per_tile, order)

"""Existence of a near neighbour: the semi and anti forms of a distance join, as one lazy plan.

1. Rows without usable coordinates have no neighbour; they stay out of the joins.
2. On a grid so fine that any two points of a cell are within the radius, a cell that holds a partner is one row, however
   many partners lie in it. A semi join with these cells settles most hits.
3. For the rest, on cells as large as the radius, distinct partner coordinates are copied to their own cell and the eight
   around it, but only to cells that hold a row still in question. The last join is on the cell with the distance as
   residual and stops at the first hit.

A crowded cell on the probing side is split by adaptive execution, which may split the left side of semi and anti joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.functions.geo import Degrees, Metres, SearchGrid, is_point
from placemill.session import shuffled


def _matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, also: Column | None = None) -> DataFrame:
    """Left rows with (or without) a right row of equal keys; right columns are told apart by a prefix."""
    right = shuffled(right.withColumnsRenamed({k: f"r{k}" for k in keys}))
    condition = F.lit(True) if also is None else also
    for k in keys:
        condition = (F.col(k) == F.col(f"r{k}")) & condition
    return left.join(right, condition, how)


def _cells(rows: DataFrame, keys: Sequence[str], *point: str) -> DataFrame:
    """The cells in use, each a few times over. The slice keeps this aggregate from being partitioned by the join keys: then
    the join has exchanges of its own on both sides, and adaptive execution may split its crowded partitions."""
    return rows.select(*keys, F.pmod(F.xxhash64(*point), F.lit(4)).alias("_slice")).distinct().drop("_slice")


def candidate_copies(spots: DataFrame, wanted: DataFrame, wide: SearchGrid, keys: Sequence[str]) -> DataFrame:
    """Each partner spot once per wanted cell it may reach."""
    copies = (
        spots.withColumn("_wy", F.explode(wide.rows_near(F.col("_plat"))))
        .withColumn("_wx", F.explode(wide.columns_near(F.col("_plon"), F.col("_wy"))))
    )
    return _matched(copies, wanted, [*keys, "_wx", "_wy"], "left_semi")


def _near_join(how: str, rows: DataFrame, partners: DataFrame, metric: Degrees | Metres, on: Sequence[str],
               lon: str, lat: str) -> DataFrame:
    fine, wide = SearchGrid(metric, SearchGrid.TOGETHER), SearchGrid(metric, 1.0)
    x, y = F.col(lon), F.col(lat)
    keys = [f"_k{i}" for i in range(len(on))]
    key_of = {k: F.col(c) for k, c in zip(keys, on, strict=True)}
    usable = is_point(x, y)
    spots = partners.where(usable).select(*[c.alias(k) for k, c in key_of.items()], x.alias("_plon"), y.alias("_plat")).distinct()
    fine_cell = lambda px, py: {"_fy": fine.row(py), "_fx": fine.column(px, fine.row(py))}
    held = _cells(spots.withColumns(fine_cell(F.col("_plon"), F.col("_plat"))), [*keys, "_fx", "_fy"], "_plon", "_plat")

    placed = rows.where(usable).withColumns({**key_of, **fine_cell(x, y), "_wy": wide.row(y), "_wx": wide.column(x, wide.row(y))})
    own = [*keys, "_fx", "_fy"]
    rest = _matched(placed, held, own, "left_anti")
    wanted = _cells(rest, [*keys, "_wx", "_wy"], lon, lat)
    copies = candidate_copies(spots, wanted, wide, keys)
    decided = _matched(rest, copies, [*keys, "_wx", "_wy"], how, metric.within(x, y, F.col("_plon"), F.col("_plat")))
    other = rows.where(~usable) if how == "left_anti" else _matched(placed, held, own, "left_semi")
    return decided.select(*rows.columns).unionByName(other.select(*rows.columns))


def having_neighbour(rows: DataFrame, partners: DataFrame, metric: Degrees | Metres, on: Sequence[str] = (),
                     lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Rows with a partner of equal ``on`` columns within the radius (inclusive). Distances are scaled at the
    row's latitude. Rows without usable coordinates have no neighbour."""
    return _near_join("left_semi", rows, partners, metric, on, lon, lat)


def without_neighbour(rows: DataFrame, partners: DataFrame, metric: Degrees | Metres, on: Sequence[str] = (),
                      lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The complement of :func:`having_neighbour`; rows without usable coordinates are kept."""
    return _near_join("left_anti", rows, partners, metric, on, lon, lat)

"""The nearest neighbours themselves, with their distance: a join by rings of growing search cells.

Rows and partners are folded to distinct spots. In each ring the spots still in question look for partners within the ring's
radius, on cells of that size; a spot with as many hits as asked for is done, since anything nearer would have been in the ring too.
Only the others go on to the next ring, ``GROWTH`` times as wide. So a spot in a crowded place is done while cells are small,
and wide cells are searched for spots with few partners around them.

The hits of a ring are written once (``stable``), since the next ring depends on them; their number is that of the rings at most
log(widest / ``FIRST_METRES``) / log(``GROWTH``) + 1.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill.functions.geo import Metres, SearchGrid, equirectangular_m, is_point
from placemill.operators.proximity import candidate_copies
from placemill.session import shuffled, stable

FIRST_METRES = 50.0
GROWTH = 5.0
PRECISION = 6  # decimals of a metre up to which distances are told apart


def rings(widest_m: float) -> list[float]:
    radii = []
    radius = FIRST_METRES
    while radius < widest_m:
        radii.append(radius)
        radius *= GROWTH
    return [*radii, widest_m]


def _ring(spots: DataFrame, partners: DataFrame, radius_m: float, k: int, keys: Sequence[str]) -> DataFrame:
    """(spot, neighbours): of each spot with a partner within the radius the ``k`` nearest, as (metres, id), nearest first."""
    grid, metric = SearchGrid(Metres(radius_m), 1.0), Metres(radius_m)
    x, y, px, py = (F.col(c) for c in ("_x", "_y", "_plon", "_plat"))
    placed = spots.withColumn("_wy", grid.row(y)).withColumn("_wx", grid.column(x, F.col("_wy")))
    wanted = placed.select(*keys, "_wx", "_wy", F.pmod(F.xxhash64("_x", "_y"), F.lit(4)).alias("_slice")).distinct().drop("_slice")
    copies = candidate_copies(partners, wanted, grid, keys).withColumnsRenamed({c: f"r{c}" for c in [*keys, "_wx", "_wy"]})
    same = reduce(lambda c, k: c & (F.col(k) == F.col(f"r{k}")), [*keys, "_wx", "_wy"], metric.within(x, y, px, py))
    found = placed.join(shuffled(copies), same).select("_spot", F.round(equirectangular_m(x, y, px, py), PRECISION).alias("metres"), F.col("_pid").alias("id"))
    if k == 1:
        return found.groupBy("_spot").agg(F.array(F.min(F.struct("metres", "id"))).alias("neighbours"))
    nearest = Window.partitionBy("_spot").orderBy("metres", "id")
    kept = found.withColumn("_n", F.row_number().over(nearest)).where(F.col("_n") <= k)
    return kept.groupBy("_spot").agg(F.array_sort(F.collect_list(F.struct("metres", "id"))).alias("neighbours"))


def nearest_neighbours(rows: DataFrame, partners: DataFrame, widest_m: float, k: int = 1, on: Sequence[str] = (), id_col: str = "id",
                       lon: str = "lon", lat: str = "lat") -> DataFrame:
    """All rows with ``neighbours``: the ``k`` nearest partners of equal ``on`` columns within ``widest_m`` (inclusive), as an array of
    (metres, id), nearest first, equal distances by id. Distances are scaled at the row's latitude and rounded to micrometres.
    Rows without usable coordinates or with a NULL key have none: an empty array."""
    x, y = F.col(lon), F.col(lat)
    keys = [f"_k{i}" for i in range(len(on))]
    key_of = [F.col(c).alias(key) for key, c in zip(keys, on, strict=True)]
    usable = is_point(x, y)
    for c in on:
        usable = usable & F.col(c).isNotNull()
    spots = rows.where(usable).select(*key_of, x.alias("_x"), y.alias("_y")).distinct()
    # a spot is known by its values; the struct keeps them together
    spots = stable(spots.select(F.struct(*keys, "_x", "_y").alias("_spot"), *keys, "_x", "_y"), "spots")
    by_spot = Window.partitionBy(*keys, "_plon", "_plat").orderBy("_pid")
    found = partners.where(usable).select(*key_of, x.alias("_plon"), y.alias("_plat"), F.col(id_col).alias("_pid"))
    if k == 1:
        found = found.groupBy(*keys, "_plon", "_plat").agg(F.min("_pid").alias("_pid"))
    else:
        found = found.withColumn("_n", F.row_number().over(by_spot)).where(F.col("_n") <= k).drop("_n")
    found = stable(found, "partner-spots")
    done: list[DataFrame] = []
    left = spots
    radii = rings(widest_m)
    for i, radius in enumerate(radii):
        hits = _ring(left, found, radius, k, keys)
        if i + 1 < len(radii):
            hits = stable(hits.where(F.size("neighbours") >= k), "ring")
            left = left.join(shuffled(hits.select("_spot")), "_spot", "left_anti")
        done.append(hits)
    everything = reduce(DataFrame.unionByName, done).withColumnRenamed("_spot", "_of")
    own = F.when(usable, F.struct(*key_of, x.alias("_x"), y.alias("_y")))
    joined = rows.withColumn("_spot", own).join(shuffled(everything), F.col("_spot") == F.col("_of"), "left")
    none = F.array().cast(everything.schema["neighbours"].dataType)
    return joined.select(*rows.columns, F.coalesce("neighbours", none).alias("neighbours"))

"""Fuzzy record linkage: near in place and a few edits apart in name.

Names are compared without white space and case. Their overlapping grams (``GRAM`` characters, the name padded at both ends) are
put in one order for all names, rarest first. Of two names within ``edits`` edits, the first ``edits * GRAM + 1`` grams of one share
a gram with those of the other, at positions at most ``edits`` apart; names so short that all their grams can change meet under a key
of their own. So pairs are joined by cell and gram, and filtered by length, position and distance before the bounded edit
distance is computed; no two records of a cell meet for lying there alone.

A record is copied once per gram of its prefix, and on the right once per cell around it that holds a left record with this gram.
How common a gram is comes from counts in ``SLOTS`` hashed slots, a list of fixed size.

``fuzzy_link`` wants one link only and asks in steps: for equal names first, then for each number of edits in growing rings. A record that
has a link is done, since whatever follows has more edits or is farther away; where records lie closely, few are left for the steps that meet many.

Records without usable coordinates or without a name have no links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.functions.geo import Metres, SearchGrid, equirectangular_m, is_point
from placemill.functions.text import squeeze_out
from placemill.operators.proximity import candidate_copies
from placemill.session import shuffled, stable

GRAM = 2
SLOTS = 1 << 14
GROWTH = 5.0  # of the rings in which the best link is looked for
_PAD = "\u0001"


def comparable(name: Column) -> Column:
    return F.lower(squeeze_out(name))


def _grams(name: Column) -> Column:
    """(gram, at) of every window of the padded name."""
    padded = F.concat(F.lit(_PAD * (GRAM - 1)), name, F.lit(_PAD * (GRAM - 1)))
    return F.transform(F.sequence(F.lit(1), F.char_length(name) + GRAM - 1),
                       lambda i: F.struct(F.substring(padded, i, F.lit(GRAM)).alias("gram"), i.alias("at")))


def _slot(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SLOTS)).cast("int")


def gram_counts(*names: DataFrame) -> Column:
    """How many names hold a gram of each slot, as a constant list of SLOTS numbers."""
    counted = None
    for frame in names:
        grams = frame.select(F.explode(F.array_distinct(F.transform(_grams(F.col("_name")), lambda g: _slot(g["gram"])))).alias("slot"))
        counted = grams if counted is None else counted.unionAll(grams)
    found = {r["slot"]: r["count"] for r in counted.groupBy("slot").count().collect()}  # SLOTS rows at most
    return F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(SLOTS))), ",").cast("array<bigint>")


def prefix_grams(name: Column, edits: int, counts: Column) -> Column:
    """(gram, at) of the rarest grams by which the name meets all names within so many edits. ``gram`` is '' in the key under
    which short names meet."""
    ranked = F.transform(_grams(name), lambda g: F.struct(F.get(counts, _slot(g["gram"])).alias("n"), g["gram"].alias("gram"), g["at"].alias("at")))
    first = F.transform(F.slice(F.array_sort(ranked), 1, edits * GRAM + 1), lambda g: F.struct(g["gram"].alias("gram"), g["at"].alias("at")))
    short = F.char_length(name) + GRAM - 1 <= edits * GRAM
    return F.when(short, F.concat(first, F.array(F.struct(F.lit("").alias("gram"), F.lit(0).alias("at"))))).otherwise(first)


def _named(rows: DataFrame, id_col: str, name: str, lon: str, lat: str) -> DataFrame:
    named = rows.where(is_point(F.col(lon), F.col(lat))).select(
        F.col(id_col).alias("_id"), comparable(F.col(name).cast("string")).alias("_name"), F.col(lon).alias("_x"), F.col(lat).alias("_y"))
    return named.where(F.col("_name") != "")


def fuzzy_pairs(left: DataFrame, right: DataFrame, radius_m: float, edits: int, id_col: str = "id", name: str = "name",
                lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(id, other_id, edits, metres) of all records within the radius of each other whose names are at most ``edits`` edits apart.
    A pair may occur several times. Distances are scaled at the left record's latitude."""
    a, b = (_named(side, id_col, name, lon, lat) for side in (left, right))
    counts = gram_counts(a.select("_name").distinct(), b.select("_name").distinct())
    return _pairs(a, b, radius_m, edits, counts).withColumnsRenamed({"_id": id_col, "_other": f"other_{id_col}"})


def _pairs(a: DataFrame, b: DataFrame, radius_m: float, edits: int, counts: Column) -> DataFrame:
    """(_id, _other, edits, metres) of named records; equal names meet by the name itself."""
    grid, metric = SearchGrid(Metres(radius_m), 1.0), Metres(radius_m)
    grams = prefix_grams(F.col("_name"), edits, counts) if edits else F.array(F.struct(F.col("_name").alias("gram"), F.lit(0).alias("at")))
    prefix = lambda df: df.withColumn("_length", F.char_length("_name")).select("*", F.inline(grams))
    a = prefix(a).withColumn("_wy", grid.row(F.col("_y"))).withColumn("_wx", grid.column(F.col("_x"), F.col("_wy")))
    b = prefix(b).withColumnsRenamed({"_x": "_plon", "_y": "_plat"})
    # the slice leaves the join exchanges of its own, which adaptive execution may split
    wanted = a.select("gram", "_wx", "_wy", F.pmod(F.xxhash64("_id"), F.lit(4)).alias("_slice")).distinct().drop("_slice")
    b = candidate_copies(b, wanted, grid, ["gram"]).select(
        *[F.col(c).alias(f"r{c}") for c in ("_id", "_name", "_length", "gram", "at", "_wx", "_wy")], "_plon", "_plat")
    met = a.join(shuffled(b), (F.col("gram") == F.col("rgram")) & (F.col("_wx") == F.col("r_wx")) & (F.col("_wy") == F.col("r_wy"))
                 & (F.abs(F.col("_length") - F.col("r_length")) <= edits) & (F.abs(F.col("at") - F.col("rat")) <= edits)
                 & metric.within(F.col("_x"), F.col("_y"), F.col("_plon"), F.col("_plat"))
                 & (F.levenshtein("_name", "r_name", edits) >= 0))
    return met.select("_id", F.col("r_id").alias("_other"), F.levenshtein("_name", "r_name", edits).alias("edits"),
                      equirectangular_m(F.col("_x"), F.col("_y"), F.col("_plon"), F.col("_plat")).alias("metres"))


def fuzzy_link(left: DataFrame, right: DataFrame, radius_m: float, edits: int, id_col: str = "id", name: str = "name",
               lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The best link of each left record that has one: fewest edits, then nearest (to the millimetre), then smallest id."""
    a, b = (stable(_named(side, id_col, name, lon, lat), "named") for side in (left, right))
    counts = gram_counts(a.select("_name").distinct(), b.select("_name").distinct())
    best = F.min(F.struct("edits", F.round("metres", 3).alias("metres"), "_other")).alias("best")
    done: list[DataFrame] = []
    for step, radius in [(0, radius_m), *[(e, r) for e in range(1, edits + 1) for r in (radius_m / GROWTH, radius_m)]]:
        hits = _pairs(a, b, radius, step, counts).groupBy("_id").agg(best)
        if radius < radius_m:  # beyond the ring another may be as near to the millimetre, and of a smaller id
            hits = hits.where(F.col("best.metres") < radius - 0.001)
        done.append(stable(hits, "links"))
        linked = shuffled(done[-1].select(F.col("_id").alias("_linked")))
        a = stable(a.join(linked, F.col("_id").eqNullSafe(F.col("_linked")), "left_anti"), "named")
        if a.isEmpty():
            break
    return reduce(DataFrame.unionByName, done).select(
        F.col("_id").alias(id_col), F.col("best._other").alias(f"other_{id_col}"), "best.edits", "best.metres")

"""The history of a register over any number of deliveries: when each shop was there, unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill import vocab
from placemill.functions.text import match_key


def keyed_states(merged: DataFrame) -> DataFrame:
    """(delivery, match_key, body) of merged snapshots that carry their ``delivery``."""
    body = F.sha2(F.to_json(F.struct(*vocab.REGISTER_COLUMNS)), 256)
    return merged.select("delivery", match_key(F.col("name"), F.col("address"), F.col("business_type")).alias("match_key"), body.alias("body"))


def register_history(states: DataFrame) -> DataFrame:
    """Validity intervals of (delivery, match_key, body): one row per run of consecutive deliveries in which a key has the same body:
    match_key, nth (from 1), first_seen, last_seen, n_deliveries, opened ('new', 'changed' or 'returned') and
    open (whether the run reaches the last delivery). Deliveries sort by name.

    Gaps and islands: deliveries are numbered in their own table (one row each), and a run begins where a key's number does not
    follow its last one or its body differs. A key's partition holds one row per delivery at most; repeated rows are folded first.
    """
    everything = Window.partitionBy(F.lit(0)).orderBy("delivery")
    numbers = states.select("delivery").distinct().withColumn("seq", F.row_number().over(everything)).withColumn(
        "last_seq", F.max("seq").over(Window.partitionBy(F.lit(0))))
    rows = states.groupBy("match_key", "delivery").agg(F.min("body").alias("body")).join(numbers, "delivery")
    by_key = Window.partitionBy("match_key").orderBy("seq")
    gap, before = F.col("seq") - F.lag("seq").over(by_key), F.lag("body").over(by_key)
    opened = F.when(gap.isNull(), "new").when(gap > 1, "returned").when(F.col("body") != before, "changed")
    runs = rows.withColumn("opened", opened)
    runs = runs.withColumn("nth", F.count("opened").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("match_key", "nth").agg(
        F.min("delivery").alias("first_seen"), F.max("delivery").alias("last_seen"), F.count(F.lit(1)).alias("n_deliveries"),
        F.max("opened").alias("opened"), F.max(F.col("seq") == F.col("last_seq")).alias("open"))


def history_at(history: DataFrame, delivery: str) -> DataFrame:
    """The intervals that hold at a delivery."""
    return history.where((F.col("first_seen") <= delivery) & (F.col("last_seen") >= delivery))

"""Dense surrogate ids without pulling the table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill.session import stable


def number_rows(df: DataFrame, id_col: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Prepend ids 1..n. With ``order_by`` they follow that order (ascending, NULLs first), else any order.

    Equal rows are folded to one with their count before anything moves, so they cannot crowd a range. What is left is
    range-partitioned by the order and the other columns, sorted inside partitions and written once to the shared
    folder with partition number and position; ids are running sums of the counts. Each row is then repeated.
    """
    columns = df.columns
    folded = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_copies"))
    if order_by:
        keys = [*order_by, *[c for c in columns if c not in order_by]]
        folded = folded.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stable(folded.withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()}), "placed")
    sizes = placed.groupBy("_part").agg(F.sum("_copies").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition written: window and broadcast are bounded by the number of partitions
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_offset") + F.coalesce(F.sum("_copies").over(within), F.lit(0)) + 1
    return placed.join(F.broadcast(offsets), "_part").withColumn("_first", first).select(
        F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_copies") - 1)).alias(id_col), *columns)

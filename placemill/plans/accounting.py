"""Row accounting as a by-product of the pass that writes a table, instead of a second run of its plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class RowCounts:
    """Counts of rows before and after a step, observed while an action runs over both. Before the action has ended there are none.

    Each side may count a column's sum instead of rows, as where one row stands for several.
    """

    def __init__(self) -> None:
        self._before, self._after = Observation(), Observation()

    @staticmethod
    def _sum(n: Column | None) -> Column:
        return F.coalesce(F.sum(F.lit(1) if n is None else n), F.lit(0)).cast("bigint").alias("n")

    def before(self, df: DataFrame, n: Column | None = None) -> DataFrame:
        return df.observe(self._before, self._sum(n))

    def after(self, df: DataFrame, n: Column | None = None) -> DataFrame:
        return df.observe(self._after, self._sum(n))

    @property
    def n_before(self) -> int:
        return self._before.get["n"]

    @property
    def n_after(self) -> int:
        return self._after.get["n"]

    @property
    def n_dropped(self) -> int:
        return self.n_before - self.n_after

"""Relations written out in code: fixed lists and the caller's own configuration."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TEXT, NUMBER = pa.string(), pa.int64()
TEXT_MAP, TEXT_LIST = pa.map_(TEXT, TEXT), pa.list_(TEXT)


def inline_relation(spark: SparkSession, columns: dict[str, pa.DataType], rows: Sequence[Sequence]) -> DataFrame:
    """A local relation, whose exact size the optimizer knows."""
    values = list(zip(*rows)) or [()] * len(columns)
    return spark.createDataFrame(pa.table({
        name: pa.array(list(v), kind) for (name, kind), v in zip(columns.items(), values)
    }))

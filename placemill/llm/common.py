"""What several operators share: reading tables, bounded Arrow batches, row keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over Arrow batches of bounded bytes, so that a run of very long texts never meets in one batch."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return stream_batches(df, each, schema)


def stream_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over the stream of a partition's batches."""
    df.sparkSession.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not use."""
    used = {c.lower() for c in df.columns}
    while name in used:
        name += "_"
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The frame with a number per row. Two passes over one table scan number its rows alike."""
    return df.withColumn(name, F.monotonically_increasing_id())


def keep_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of a table scan whose number is in ``rows`` (row), all columns."""
    number = fresh(docs, "_row")
    return numbered(docs, number).join(rows.select(F.col("row").alias(number)), number, "left_semi").select(*docs.columns)


def schema_text(df: DataFrame) -> str:
    """The frame's schema as text that keeps odd column names."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def unit_hash(*columns: Column) -> Column:
    """A number in [0, 1) decided by the columns' text: 48 bits of md5, which other engines have too."""
    text = F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)

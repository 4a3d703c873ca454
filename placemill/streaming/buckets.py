"""The register kept in buckets of its keys, of which a delivery rewrites only those that it changes.

Rows lie below ``<path>/rows`` and the merged register below ``<path>/merged`` (and the latest delivery of each source, one row per
source, below ``<path>/sources``), both in the same ``BUCKETS`` folders by a hash of the
match key. A delivery replaces all rows of the sources that it holds. Old and new rows of these sources are compared by a sum of row
hashes per bucket, BUCKETS numbers at most, and only buckets that differ are read, merged and written (dynamic partition overwrite).
Since equal keys share a bucket, merging is local to it.

The merged buckets are written before the rows: after a failure in between, the next run finds the same difference and repeats both.
Each bucket written holds one blank row besides (NULL srcid), so that a bucket that loses all its rows is overwritten, too.
A source's delivery must arrive as a whole; one that is older than what is kept is ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placemill.functions.text import match_key
from placemill.operators.registers import merge_register
from placemill.session import stable
from placemill.sources.registry import SourceSpec
from placemill.streaming.intake import arriving_rows

BUCKETS = 256


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    key = match_key(F.col("name"), F.col("address"), F.col("business_type"))
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A bucketed table without its blank rows; empty if it has not been written yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return like.where("false")
    return spark.read.schema(like.schema).parquet(path).where("srcid IS NOT NULL")


def _write(df: DataFrame, touched: DataFrame, path: str) -> None:
    blank = touched.select(*[F.col("bucket") if c == "bucket" else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    whole = df.unionByName(blank).repartition("bucket")
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("bucket").parquet(path)


def refresh(rows: DataFrame, path: str, buckets: int = BUCKETS) -> list[int]:
    """Take in the rows of one or several deliveries (harmonised, with ``delivery``); the numbers of the buckets rewritten."""
    spark = rows.sparkSession
    arrived = stable(_bucketed(rows, buckets), "arrived")
    kept = _stored(spark, f"{path}/rows", arrived)
    # one row per source: the latest delivery that arrived, unless a later one is kept
    latest = arrived.groupBy("srcid").agg(F.max("delivery").alias("delivery"))
    taken = _stored(spark, f"{path}/sources", latest)
    held = taken.withColumnRenamed("delivery", "held")
    current = stable(latest.join(held, "srcid", "left").where("held IS NULL OR held <= delivery").select("srcid", "delivery"), "current")
    new = arrived.join(F.broadcast(current), ["srcid", "delivery"], "left_semi").select(*arrived.columns)
    old = kept.join(F.broadcast(current.select("srcid")), "srcid", "left_semi").select(*arrived.columns)

    def sums(df: DataFrame, sign: int) -> DataFrame:
        body = [c for c in df.columns if c != "delivery"]
        return df.groupBy("bucket").agg(F.sum(F.xxhash64(*body).cast("decimal(38,0)") * sign).alias("digest"), F.sum(F.lit(sign)).alias("n"))

    differing = sums(new, 1).unionByName(sums(old, -1)).groupBy("bucket").agg(F.sum("digest").alias("digest"), F.sum("n").alias("n"))
    touched = stable(differing.where("digest <> 0 OR n <> 0").select("bucket"), "touched")
    numbers = sorted(r["bucket"] for r in touched.collect())
    if numbers:
        others = kept.where(F.col("bucket").isin(numbers)).join(F.broadcast(current.select("srcid")), "srcid", "left_anti").select(*arrived.columns)
        whole = stable(others.unionByName(new.where(F.col("bucket").isin(numbers))), "bucket-rows")
        _write(_bucketed(merge_register(whole), buckets), touched, f"{path}/merged")
        _write(whole, touched, f"{path}/rows")
    sources = taken.join(F.broadcast(current.select("srcid")), "srcid", "left_anti").unionByName(current)
    stable(sources, "sources").coalesce(1).write.mode("overwrite").parquet(f"{path}/sources")
    return numbers


def merged_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The merged register as it stands."""
    return spark.read.parquet(f"{path}/merged").where("srcid IS NOT NULL").drop("bucket")


def take_in(spark: SparkSession, folder: str, specs: Sequence[SourceSpec], path: str, progress_path: str,
            buckets: int = BUCKETS) -> StreamingQuery:
    """Refresh from every file that is new below ``folder`` and stop. A repeated batch changes nothing."""
    def each(rows: DataFrame, _: int) -> None:
        refresh(rows, path, buckets)

    return (
        arriving_rows(spark, folder, specs).writeStream.foreachBatch(each)
        .option("checkpointLocation", progress_path).trigger(availableNow=True).start()
    )

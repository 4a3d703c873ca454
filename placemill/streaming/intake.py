"""Periodic refresh: take in register files as they arrive, keep the rows, rebuild the merged snapshot.

Each delivery is a subfolder whose name sorts after those before it (``2024-05``, ``2024-06``); the file names inside may
stay the same or carry dates. An entry's path, whose last part may hold ``*`` and ``?``, names its files in any delivery.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placemill.operators.registers import merge_register, normalize_records, register_changes
from placemill.sources.registers import decode_files
from placemill.sources.registry import SourceSpec, registry_frame

_SEPARATOR = "\n"


def _named(path: Column, spec: SourceSpec) -> Column:
    name = re.escape(spec.path.rsplit("/", 1)[-1]).replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
    return path.rlike(f"/{name}$")


def arriving_rows(spark: SparkSession, folder: str, specs: Sequence[SourceSpec]) -> DataFrame:
    """Harmonised rows with their ``delivery``; each file is read once. A file that no entry names fails the batch."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true").load(folder)
    )
    path = F.col("path")
    entries = F.array_compact(F.array(*[F.when(_named(path, s), F.lit(s.id)) for s in specs]))
    known = F.when(F.size(entries) > 0, entries).otherwise(F.raise_error(F.concat(F.lit("no register for "), path)))
    placed = files.select("content", F.element_at(F.split(path, "/"), -2).alias("delivery"), F.explode(known).alias("source_id"))
    settings = registry_frame(spark, specs).select("source_id", "format", "encoding", "header_row", "sheet")
    tagged = placed.join(F.broadcast(settings), "source_id").withColumn("source_id", F.concat_ws(_SEPARATOR, "source_id", "delivery"))
    part = lambda n: F.split_part("source_id", F.lit(_SEPARATOR), F.lit(n))
    records = decode_files(tagged).withColumns({"delivery": part(2), "source_id": part(1)})
    return normalize_records(records, specs, extra=("delivery",))


def take_in(spark: SparkSession, folder: str, specs: Sequence[SourceSpec], rows_path: str,
            progress_path: str) -> StreamingQuery:
    """Append everything new to ``rows_path`` and stop. A rerun after a failure neither skips nor repeats files."""
    return (
        arriving_rows(spark, folder, specs)
        .writeStream.format("parquet").option("path", rows_path).option("checkpointLocation", progress_path)
        .outputMode("append").trigger(availableNow=True).start()
    )


def current_rows(rows: DataFrame, until: str | None = None) -> DataFrame:
    """The rows of each source's latest delivery, up to and including ``until``."""
    past = rows if until is None else rows.where(F.col("delivery") <= until)
    latest = past.groupBy("srcid").agg(F.max("delivery").alias("delivery"))  # one row per register
    return past.join(latest, ["srcid", "delivery"], "left_semi").drop("delivery")


def snapshot(spark: SparkSession, rows_path: str, until: str | None = None) -> DataFrame:
    """The merged register as of the latest delivery of each source."""
    return merge_register(current_rows(spark.read.parquet(rows_path), until))


def refresh_changes(spark: SparkSession, rows_path: str, old: str, new: str) -> DataFrame:
    """What changed in the merged register between two deliveries."""
    return register_changes(snapshot(spark, rows_path, old), snapshot(spark, rows_path, new))

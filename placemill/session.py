"""Session helpers: builder for local use, and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "placemill", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def drop_scratch(spark: SparkSession) -> None:
    """Remove all tables that operators have left below the shared folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{shared_dir(spark).rstrip('/')}/placemill-*")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.globStatus(pattern) or []:
        files.delete(found.getPath(), True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers of a cluster on which it is not installed."""
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="spark-placemill-")) / "placemill.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted((root / "placemill").rglob("*.py")):
            z.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; a cluster without the setting is refused,
    because a machine-local folder is lost with its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-placemill-"))
    return context.getCheckpointDir()


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast, nor the other side: for joins both sides of which grow with the data. The optimizer
    goes by the size of files, which are compressed and whose rows are exploded later on, and a broadcast passes through the driver."""
    return df.hint("merge")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/placemill-{name}-{uuid.uuid4().hex}"


def stable(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back.

    Later passes see the very same rows whatever happens to executors, and read only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

import random

from pyspark.sql import functions as F

from placemill.plans.accounting import RowCounts
from placemill.session import stable
from placemill.sinks.layout import write_clustered
from placemill.sinks.tables import write_parquet


def rows_scanned(spark, df):
    """The number of rows that leave the scan, after row groups were skipped."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    scan = query.executedPlan()
    while scan.children().size():
        scan = scan.children().apply(0)
    return scan.metrics().apply("numOutputRows").value()


def test_a_window_skips_row_groups(spark, tmp_path):
    rng = random.Random(1)
    points = [(i, rng.uniform(130, 140), rng.uniform(30, 40)) for i in range(20_000)] + [(-1, None, 35.0), (-2, float("nan"), 35.0)] + [(30_000 + i, 135.0, 35.0) for i in range(3000)]
    layer = spark.createDataFrame(points, "id int, lon double, lat double").repartition(4)
    write_parquet(layer, str(tmp_path / "plain"))
    write_clustered(layer, str(tmp_path / "clustered"), F.col("lon"), F.col("lat"), files=4, group_rows=500)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain, clustered = (spark.read.parquet(str(tmp_path / n)) for n in ("plain", "clustered"))
        assert sorted(map(str, clustered.collect())) == sorted(map(str, layer.collect())) and clustered.columns == layer.columns
        window = lambda df: df.where(F.col("lon").between(131, 132) & F.col("lat").between(31, 32))
        assert sorted(r.id for r in window(clustered).collect()) == sorted(r.id for r in window(plain).collect())
        assert rows_scanned(spark, window(clustered)) * 4 < rows_scanned(spark, window(plain))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_counts_come_with_the_write(spark):
    counted = RowCounts()
    rows = spark.range(100).withColumn("w", F.col("id") % 3)
    out = counted.after(counted.before(rows, F.col("w")).where("id < 10"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    stable(out, "counted")
    ran = len(jobs.getJobIdsForGroup("counted"))
    assert (counted.n_before, counted.n_after, counted.n_dropped) == (99, 10, 89)
    assert len(jobs.getJobIdsForGroup("counted")) == ran  # asking for them runs nothing
    empty = RowCounts()
    stable(empty.after(empty.before(rows.where("false"))), "counted")
    assert (empty.n_before, empty.n_after) == (0, 0)

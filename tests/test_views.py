"""The input views are dealt out over tasks, however few files the tables are."""

from placemill_checks import frames


def test_register_rows_are_in_many_tasks(spark, tmp_path):
    rows = spark.range(400).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "cast(id % 25 AS int) AS c_nationkey", "'M' AS c_mktsegment")
    rows.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    for view in (frames.register(spark, str(tmp_path), "reg_a"), frames.areas(spark, str(tmp_path))):
        per_task = view.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert sum(per_task) == 400 and max(per_task) <= 400 / 4

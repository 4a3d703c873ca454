import json
import struct

import pytest
from pyspark.sql import functions as F

from placemill import session
from placemill.operators import branches, features, tiles
from placemill.operators.numbering import number_rows
from placemill.operators.regions import build_region_index, tally_regions
from placemill.plans import master as M
from placemill.plans import reports
from placemill.sinks.features import write_geojson_lines
from placemill.sinks.tables import with_geometry, write_csv, write_master, write_register_csv
from placemill.sources.places import scan_community_tsv

PLACE = "name string, category string, category_alt array<string>, brand_name string, lon double, lat double"


@pytest.fixture(scope="module")
def inputs(spark):
    places = spark.createDataFrame([
        ("S", "supermarket", None, "B", 1.0, 1.0), ("G near", "grocery_store", None, None, 1.00109, 1.0),
        ("G far", "grocery_store", None, None, 1.00111, 1.0), ("G cafe", "grocery_store", None, None, 2.0, 1.0),
        (None, "grocery_store", None, None, 2.0, 1.0), ("G bar", "grocery_store", ["bar"], None, 2.0, 1.0),
        ("C", "convenience_store", None, None, 2.0, 2.0), ("D", "drugstore", None, None, 2.5, 2.0),
        ("F", "butcher_shop", None, None, 3.0, 3.0), ("M", "farmers_market", None, None, 3.0, 3.0),
        ("P", "pharmacy", None, None, 3.0, 3.0), ("Out", "supermarket", None, None, 50.0, 3.0),
        ("No place", "supermarket", None, None, None, None),
    ], PLACE)
    tagged = spark.createDataFrame([
        ("o1", "butcher", None, "3.0005", "3"), ("o2", "seafood", None, "3.1", "3"), ("o3", "Butcher", None, "3.2", "3"),
        ("o4", "greengrocer", None, "n/a", "3"), ("o5", None, "marketplace", "3.3", "3"),
    ], "name string, shop string, amenity string, `@lon` string, `@lat` string")
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    edges = spark.createDataFrame([("R", *a, *b) for a, b in zip(square, square[1:])], "pref string, ax double, ay double, bx double, `by` double")
    return places, tagged, edges


def test_master(inputs):
    got = [(r.store_id, r.cat, r.name, r.src, r.prefecture) for r in M.build_master(*inputs).orderBy("store_id").collect()]
    assert got == [
        (1, "convenience", "C", "overture", "R"), (2, "drugstore", "D", "overture", "R"), (3, "fresh_food", "o2", "osm", "R"),
        (4, "fresh_food", "F", "overture", "R"), (5, "supermarket", "S", "overture", "R"), (6, "supermarket", "G far", "overture", "R")]


def test_candidates_keep_rows_without_coordinates(inputs):
    names = [r.name for r in M.candidates(*inputs[:2]).collect()]
    assert sorted(names) == sorted(["S", "Out", "No place", "G far", "C", "D", "F", "o2", "o4"])
    acc = reports.row_accounting(tally_regions(M.candidates(*inputs[:2]), build_region_index(inputs[2]))).first()
    assert tuple(acc) == (9, 6, 3)


def test_metric_variant(inputs):
    from placemill.functions.geo import Metres

    names = {r.name for r in M.unique_groceries(inputs[0], Metres(200.0)).collect()}
    assert names == set()


def test_numbers_are_dense_and_ordered_even_for_equal_rows(spark):
    rows = spark.range(3000).select((F.col("id") % 7).cast("string").alias("k"), F.lit("x").alias("v")).unionByName(
        spark.range(2000).select(F.lit("3").alias("k"), F.lit("x").alias("v")))
    got = number_rows(rows.repartition(6), "n", ["k", "v"]).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 5001))
    assert [r.k for r in got] == sorted(r.k for r in got)
    free = number_rows(rows, "n").select("n").collect()
    assert sorted(r.n for r in free) == list(range(1, 5001))


def test_empty_numbering(spark):
    assert number_rows(spark.range(0), "n").count() == 0


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        chosen = None

        def getCheckpointDir(self):
            return self.chosen

        def setCheckpointDir(self, path):
            self.chosen = path

    class Session:
        sparkContext = Context()
        named = None

        class conf:
            @staticmethod
            def get(key, default):
                return Session.named

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session)
    Session.named = "hdfs:///shared"
    assert session.shared_dir(Session) == "hdfs:///shared" and Session.sparkContext.chosen == "hdfs:///shared"


def test_duplicate_ids_count_as_the_joined_report_does(spark):
    rows = spark.createDataFrame([
        ("x", "ローソン", 135.0, 35.0), ("x", "ローソン", 136.0, 35.0), ("y", "ローソン A店", 135.0001, 35.0), ("z", None, 135.0, 35.0),
        ("w", "個人", 135.0, 35.0)], "id string, name string, lon double, lat double").withColumn("category", F.lit("convenience_store"))
    got = [tuple(r) for r in branches.duplicate_report(rows).collect()]
    assert got == [(None, 1, 3, 2, 1, 3), ("その他", 0, 1, 0, 1, 2), ("ローソン", 1, 2, 2, 0, 1)]


def test_report_order_and_text(inputs):
    places, tagged, _ = inputs
    got = reports.compare_sources(places, tagged)
    assert [r.bucket for r in got.collect()] == ["super", "conv", "drug", "grocery", "fresh"]
    shown = reports.with_display_text(reports.coverage_ratio(got), ["official"], ["primary_pct"]).orderBy("bucket").first()
    assert (shown.official, shown.primary_pct) == ("56,352", "0.0%")


def test_wkb_matches_the_format(spark):
    rows = spark.createDataFrame([(139.5, 35.25), (None, 1.0), (-1e-9, -90.0)], "lng double, lat double")
    got = [r.geom for r in with_geometry(rows).collect()]
    assert got == [bytearray(struct.pack("<BIdd", 1, 1, 139.5, 35.25)), None, bytearray(struct.pack("<BIdd", 1, 1, -1e-9, -90.0))]


def test_master_files(spark, inputs, tmp_path):
    master = M.build_master(*inputs)
    write_master(master, str(tmp_path / "p"), str(tmp_path / "c"))
    assert "geom" in spark.read.parquet(str(tmp_path / "p")).columns
    back = spark.read.csv(str(tmp_path / "c"), header=True, inferSchema=True)
    assert back.columns == ["store_id", *M.MASTER] and back.count() == 6


def test_csv_quotes(spark, tmp_path):
    rows = spark.createDataFrame([('a "b", c', "", None)], "x string, y string, z string")
    write_csv(rows, str(tmp_path / "c"))
    lines = {line for f in (tmp_path / "c").glob("*.csv") for line in f.read_text().splitlines()}
    assert lines == {"x,y,z", '"a ""b"", c",,'}


def test_register_csv_keeps_the_column_order(spark, tmp_path):
    from placemill import vocab

    rows = spark.createDataFrame([tuple("1" * 16)], ", ".join(f"{c} string" for c in reversed(vocab.REGISTER_COLUMNS)))
    write_register_csv(rows, str(tmp_path / "r"))
    assert next((tmp_path / "r").glob("*.csv")).read_text().splitlines()[0] == ",".join(vocab.REGISTER_COLUMNS)


def test_geojson_lines(spark, tmp_path):
    rows = spark.createDataFrame([("A\t\"x\"", "drugstore", 1.0, 2.0, None), (None, None, None, 1.0, 0.5)],
                                 "name string, category string, lon double, lat double, confidence double")
    write_geojson_lines(rows, str(tmp_path / "g"))
    lines = [line for f in (tmp_path / "g").glob("*.txt") for line in f.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [{
        "type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]},
        "properties": {"name": "A\t\"x\"", "cat": "drug", "cat_raw": "drugstore", "confidence": None}}]


def test_cards(spark):
    rows = spark.createDataFrame([("1", "", "", 0.126), ("2", None, None, None), ("3", "N", "drugstore", 1.0)],
                                 "id string, name string, category string, confidence double")
    got = [tuple(r) for r in features.place_cards(rows).orderBy("id").collect()]
    assert got == [("1", "fresh", "(名称なし)", "fresh", "0.13"), ("2", "fresh", "(名称なし)", "fresh", None), ("3", "drug", "N", "drugstore", "1.00")]
    assert features.place_cards(rows, "drug").count() == 1


def test_tsv_types(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("shop\tname\tamenity\t@lat\t@lon\nbutcher\tA\t\t35\t135.5\nbutcher\tB\t\t35\tn/a\n")
    assert dict(scan_community_tsv(spark, str(tmp_path / "t.tsv")).dtypes)["@lon"] == "string"
    typed = scan_community_tsv(spark, str(tmp_path / "t.tsv"), all_text=False)
    assert [(r["name"], r["@lon"], r["@lat"]) for r in typed.collect()] == [("A", 135.5, 35.0), ("B", None, 35.0)]


def test_tiles_match_known_indexes(spark):
    rows = spark.createDataFrame([(139.7671, 35.6812), (-180.0, 85.06), (180.0, -90.0), (0.0, 0.0)], "lon double, lat double")
    assert [(r.x, r.y) for r in tiles.tile_index(rows, 12).collect()] == [(3638, 1612), (0, 0), (4095, 4095), (2048, 2048)]


@pytest.mark.parametrize("threshold", ["1000", "2"])
def test_thinning_equals_ranking_every_tile_as_a_whole(spark, threshold):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    rows = spark.range(3000).select(
        F.col("id"), (F.lit(135.0) + (F.col("id") % 40) * 0.05).alias("lon"), (F.lit(35.0) + (F.col("id") % 30) * 0.05).alias("lat"),
        (F.col("id") * 7919 % 101 / 101).alias("confidence"))
    order = [F.desc("confidence"), F.asc("id")]
    got = {(r.z, r.x, r.y, r.id, r.tile_rank) for r in tiles.thin_tiles(rows, 5, order, 8).collect()}
    from pyspark.sql import Window

    want = set()
    for z in range(9):
        ranked = tiles.tile_index(rows, z).withColumn("tile_rank", F.row_number().over(Window.partitionBy("x", "y").orderBy(*order)))
        want |= {(r.z, r.x, r.y, r.id, r.tile_rank) for r in ranked.where("tile_rank <= 5").collect()}
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert got == want


def test_two_decimals_by_the_exact_value(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    rng = random.Random(1)
    values = [0.145, 1.005, 0.285, 0.125, 0.375, 0.0, 1.0, 0.995, None] + [rng.random() for _ in range(2000)] + [rng.randrange(1000) / 1000 for _ in range(500)]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", features.two_decimals(F.col("v")).alias("t")).collect()
    want = {i: None if v is None else str(Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_UP)) for i, v in enumerate(values)}
    assert {r.i: r.t for r in got} == want


def test_tsv_quotes(spark, tmp_path):
    (tmp_path / "q.tsv").write_text('name\t@lon\t@lat\n"Bob ""X"" shop"\t1.5\tx\nplain\t"2"\t3\n')
    got = scan_community_tsv(spark, str(tmp_path / "q.tsv"), all_text=False).collect()
    assert [tuple(r) for r in got] == [('Bob "X" shop', 1.5, None), ("plain", 2.0, 3.0)]


def test_ids_of_equal_rows(spark):
    df = spark.range(0, 5000, 1, 8).select(F.when(F.col("id") < 4000, "same").otherwise(F.col("id").cast("string")).alias("v"))
    got = number_rows(df, "n", ["v"]).collect()
    assert sorted(r.n for r in got) == list(range(1, 5001))
    assert [r.v for r in sorted(got, key=lambda r: r.n)] == sorted(r.v for r in got)

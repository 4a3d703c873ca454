from pyspark.sql import functions as F

from conftest import plan_of
from placemill import schemas
from placemill.operators import providers
from placemill.operators.extract import extract_places
from placemill.plans.places import extract_and_dedup
from placemill.sources.places import scan_raw_places


def raw(id, category="supermarket", lon=135.0, lat=35.0, addresses=(("JP", "r", "l", "f"),), name="A", datasets=("Overture", "meta"), confidence=0.5):
    return (id, (name,), (category, ["alt"]), confidence, ("Q1", ("Brand",)), "open", list(addresses) if addresses is not None else None,
            [(d,) for d in datasets], (lon, lat))


def test_flatten_and_filter(spark):
    rows = spark.createDataFrame([
        raw("a"), raw("b", lon=122.5, lat=24.0), raw("c", lon=154.0, lat=45.8), raw("d", lon=122.4999), raw("e", lat=45.81),
        raw("f", category="restaurant"), raw("g", addresses=()), raw("h", addresses=None),
        raw("i", addresses=(("KR", None, None, None), ("JP", "x", "y", "z"))), raw("j", category=None),
    ], schemas.PLACES_RAW)
    got = {r.id: r for r in extract_places(rows).collect()}
    assert set(got) == set("abcghi")
    assert got["g"].country is None and got["h"].country is None and got["i"].country == "KR"
    assert got["a"].asDict() == {
        "id": "a", "name": "A", "category": "supermarket", "category_alt": ["alt"], "confidence": 0.5, "brand_wikidata": "Q1",
        "brand_name": "Brand", "operating_status": "open", "country": "JP", "region": "r", "locality": "l", "address": "f",
        "datasets": ["Overture", "meta"], "lon": 135.0, "lat": 35.0}
    assert {r.id for r in extract_places(rows, min_confidence=0.6).collect()} == set()


def test_predicates_and_pruning_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([raw("a")], schemas.PLACES_RAW).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = plan_of(extract_places(scan_raw_places(spark, path)).select("id", "datasets", "lon"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for wanted in ("GreaterThanOrEqual(bbox.xmin,122.5)", "LessThanOrEqual(bbox.ymin,45.8)", "In(categories.primary"):
        assert wanted in plan
    read = plan[plan.index("ReadSchema"):]
    assert "sources:array<struct<dataset:string>>" in read and "alternate" not in read and "brand" not in read


def flat(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, category string, country string, datasets array<string>")


def test_best_provider_rule(spark):
    rows = flat(spark, [
        ("keep", "ローソン 店", "convenience_store", "JP", ["Overture", "AllThePlaces"]),
        ("drop", "ローソン 店", "convenience_store", "JP", ["Overture", "meta"]),
        ("null_sets", "ローソン", "convenience_store", "JP", None),
        ("null_inside", "ローソン", "convenience_store", "JP", [None, "meta"]),
        ("any_category", "ミニストップ", "supermarket", "JP", ["meta"]),
        ("no_chain", "八百屋", "grocery_store", "JP", None), ("no_name", None, "grocery_store", "JP", ["x"]),
        ("abroad", "八百屋", "grocery_store", "KR", ["x"]), ("no_country", "八百屋", "grocery_store", None, ["x"]),
        ("pharmacy", "八百屋", "pharmacy", "JP", ["x"]), ("no_category", "八百屋", None, "JP", ["x"]),
    ])
    got = {r.id: (r.chain, r.dedup_method) for r in providers.keep_best_provider(rows).collect()}
    assert got == {
        "keep": ("ローソン", "best-provider"), "any_category": ("ミニストップ", "best-provider"),
        "no_chain": (None, "as-is"), "no_name": (None, "as-is")}
    own = spark.createDataFrame([("ローソン", "meta")], "chain string, provider string")
    assert {r.id for r in providers.keep_best_provider(rows, own).collect()} == {"drop", "no_chain", "no_name", "null_inside"}


def test_compositions(spark):
    rows = flat(spark, [("a", "ローソン", "c", "JP", ["Overture", "meta"]), ("b", "ローソン", "c", "JP", ["meta", "meta"]),
                        ("c", "ローソン", "c", "KR", ["x"]), ("d", "z", "c", "JP", ["Overture", "y"])])
    assert {tuple(r) for r in providers.provider_composition(rows).collect()} == {("meta", 2, 66.6667), ("y", 1, 33.3333)}
    assert {tuple(r) for r in providers.best_provider_by_chain(rows).collect()} == {("ローソン", "meta", 2)}
    assert {tuple(r) for r in providers.country_composition(rows).collect()} == {("JP", 3), ("KR", 1)}


def test_pipeline_through_files(spark, tmp_path):
    raw_path, full, layer = (str(tmp_path / n) for n in ("raw", "full", "layer"))
    spark.createDataFrame([raw("a"), raw("b", name="ローソン")], schemas.PLACES_RAW).write.parquet(raw_path)
    extract_and_dedup(spark, raw_path, full, layer)
    out = spark.read.parquet(layer)
    assert [r.id for r in out.collect()] == ["a"] and len(out.columns) == 16
    assert [f.name for f in (tmp_path / "layer").iterdir() if f.is_dir()] == ["category=supermarket"]
    assert all(f.name.endswith(".zstd.parquet") for f in (tmp_path / "full").glob("*.parquet"))
    assert spark.read.parquet(full).where(F.col("id") == "b").count() == 1

from pyspark.sql import functions as F

from placemill import vocab
from placemill.functions import classify as C


def column(spark, values, expr, kind="string"):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in rows.select(expr(F.col("v"))).collect()]


def test_chains_first_match_wins_and_null_stays(spark):
    names = ["セブン-イレブン 本店", "セブンイレブンローソン", "新ローソン", "ファミマ!!", "ファミリーマート", "ミニストップ", "デイリーヤマザキ", "八百屋", "", None]
    assert column(spark, names, C.chain_of) == [
        "セブンイレブン", "セブンイレブン", "ローソン", "ファミリーマート", "ファミリーマート", "ミニストップ", "デイリーヤマザキ", None, None, None]
    assert column(spark, names, C.chain_or_other)[-3:] == ["その他"] * 3


def test_branch_flag_is_three_valued(spark):
    assert column(spark, ["A店", "店 ", "A", None], C.is_branded) == [True, False, False, None]


def test_buckets(spark):
    assert column(spark, ["supermarket", "drugstore", "butcher_shop", "x", None], C.category_bucket) == [
        "super", "drug", "fresh", "fresh", "fresh"]
    rows = spark.createDataFrame(
        [("Supermarket", None), ("DELI", "cafe"), ("chemist", None), ("Farm", None), (None, "MarketPlace"), (None, None),
         ("books", "marketplace"), ("books", None), ("convenience", "marketplace")], "s string, a string")
    got = [r[0] for r in rows.select(C.shop_bucket(F.col("s"), F.col("a"))).collect()]
    assert got == ["super", "grocery", "drug", "fresh", "fresh", None, "fresh", None, "conv"]


def test_labels(spark):
    got = column(spark, ["drugstore", "", "zzz", None], lambda c: C.label_of(c, vocab.MASTER_LABELS, vocab.OTHER_LABEL))
    assert got == ["ドラッグストア (drugstore)"] + [vocab.OTHER_LABEL] * 3


def test_noise_three_valued_logic(spark):
    rows = spark.createDataFrame([
        ("a", "八百屋", None), ("b", "八百屋", ["cafe"]), ("c", "八百屋", ["cafe", "bakery"]), ("d", "My CAFE", ["farm"]),
        ("e", "ｚａｋｋａ", []), ("f", "Zakkaya", None), ("g", None, None), ("h", None, ["cafe"]), ("i", None, ["farm"]),
        ("j", "八百屋", []), ("k", "八百屋", [None, "bar"]), ("l", "八百屋", ["books"]),
    ], "id string, name string, tags array<string>")
    noise = C.is_noise(F.col("name"), F.col("tags"))
    kept = {r.id for r in rows.where(~noise).collect()}
    assert kept == {"a", "c", "e", "j", "l"}

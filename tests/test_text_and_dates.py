import pytest
from pyspark.sql import functions as F

from placemill.functions.dates import normalize_date
from placemill.functions.geo import parse_degrees
from placemill.functions.text import is_filled, join_filled, match_key, squeeze_out, strip

DATES = {
    "2024/03/19": "2024-03-19", "2024-3-9": "2024-03-09", "2024.03/19": "2024-03-19",
    "2024-03-19 00:00:00": "2024-03-19", " 2024/1/2\n": "2024-01-02", "45212": "2023-10-13", "20000": "1954-10-03",
    "60000": "2064-04-08", "19999": "", "60001": "", "2024": "", "123456": "", "R02/09/30": "2020-09-30",
    "H8.6.12": "1996-06-12", "S64.1.8": "1989-01-08", "H31.4.30": "2019-04-30", "M45.7.29": "1912-07-29",
    "T1.8.1": "1912-08-01", "令和2年9月30日": "2020-09-30", "平成30年1月2日": "2018-01-02", "昭和 3年1月2日": "",
    "明治1年1月2日": "1868-01-02", "大正2年1月2": "1913-01-02", "令和元年5月1日": "", "令2年9月30日": "",
    "2024年3月19日": "", "02/09/30": "", "r02/09/30": "", "R2年9.30": "2020-09-30", "R.2.9.30": "2020-09-30",
    "令和 2年9月30日": "", "2024/02/30": "", "2024/02/29": "2024-02-29", "2023/02/29": "", "2024/13/01": "",
    "2024/00/01": "", "0000/01/01": "", "0001/01/01": "0001-01-01", "-": "", "—": "", "": "", "nan": "", "None": "",
    "NaN": "", "　": "", "２０２４/03/19": "2024-03-19", "４５２１２": "2023-10-13", "R２.９.３０": "2020-09-30",
    "٢٠٢٤/03/19": "2024-03-19", "2024/03/19x": "", "x2024/03/19": "", "令和5元3年1月1日": "", "令和元3年1月1日": "2021-01-01",
}


def test_dates(spark):
    rows = spark.createDataFrame([(k, v) for k, v in DATES.items()] + [(None, "")], "raw string, want string")
    wrong = rows.withColumn("got", normalize_date(F.col("raw"))).where("got IS DISTINCT FROM want").collect()
    assert wrong == []


SPACES = [chr(i) for i in range(0x10000) if chr(i).isspace()]


def test_strip_removes_exactly_the_unicode_spaces(spark):
    samples = [f"{s}a{s}b{s}" for s in SPACES] + ["​a​", "plain", "", " ", "﻿a"]
    rows = spark.createDataFrame([(s,) for s in samples], "s string")
    got = rows.select("s", strip(F.col("s")).alias("t"), squeeze_out(F.col("s")).alias("q"), is_filled(F.col("s")).alias("f")).collect()
    for r in got:
        assert r.t == r.s.strip()
        assert r.q == "".join(c for c in r.s if not c.isspace())
        assert r.f == (r.s.strip() != "")


def test_joining_and_key(spark):
    row = spark.createDataFrame([(" 東京　", "", "　", "1 丁目")], "a string, b string, c string, d string").select(
        join_filled([F.col(c) for c in "abcd"]).alias("joined"),
        match_key(F.col("a"), F.col("d"), F.col("b")).alias("key"),
        join_filled([F.col("b"), F.col("c")]).alias("none"), is_filled(F.lit(None).cast("string")).alias("null"),
    ).first()
    assert tuple(row) == ("東京 1 丁目", "東京|1丁目|", "", False)


@pytest.mark.parametrize("text,value", [
    ("135.5", 135.5), ("-3", -3.0), (" 1e2 ", 100.0), (".5", 0.5), ("5.", 5.0), ("n/a", None), ("1_0", None),
    ("1e3d", None), ("1.5f", None), ("", None), ("nan", None), (None, None), ("1,5", None),
])
def test_parse_degrees(spark, text, value):
    assert spark.createDataFrame([(text,)], "s string").select(parse_degrees(F.col("s"))).first()[0] == value

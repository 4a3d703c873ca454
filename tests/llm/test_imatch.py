import hashlib

from pyspark.sql import functions as F

from placemill.llm import imatch
from tests.llm.helpers import awkward, prose, table


def rows_of(spark, rows):
    return imatch.fingerprints(table(spark, rows)).withColumns(
        {"fingerprint": imatch.shown(F.col("print")), "edited_sha": F.sha2("edited", 256)}).collect()


def test_edited_text_and_order(spark):
    rows = [r for r in awkward() if r[0] is not None and r[0] != 10]
    got = {r["doc_id"]: r for r in rows_of(spark, rows)}
    order = sorted(rows, key=lambda r: -r[0])
    for (doc_id, text, *_), (_, after, *_) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        k = len(text) // 3
        assert got[doc_id]["n_chars"] == len(text)
        assert got[doc_id]["edited_sha"] == hashlib.sha256((text[:len(text) - k] + after[:k]).encode()).hexdigest()
        assert 0 <= got[doc_id]["near_edited"] <= 1 and 0 <= got[doc_id]["near_next"] <= 1
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[1]["near_next"] < 1
    assert got[2]["near_next"] == 1  # followed by its copy


def test_likeness_tells_edits_from_strangers(spark):
    got = rows_of(spark, [(i, prose(60 + i, i), "en", "a") for i in range(150)])
    assert sum(r["near_edited"] for r in got) / 150 > 0.3 and sum(r["near_next"] for r in got) / 150 < 0.1
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 147


def test_nulls_repeats_single_and_empty(spark):
    got = rows_of(spark, awkward())
    assert len(got) == len(awkward())
    assert {r["near_next"] for r in got if r["doc_id"] == 10} >= {1.0}
    alone = rows_of(spark, [(1, "abcdef", "en", "a")])
    assert alone[0]["near_next"] == 1 and alone[0]["edited"] == "abcdab"
    assert rows_of(spark, []) == []


def test_no_python_on_the_main_path(spark):
    plan = imatch.fingerprints(table(spark, awkward()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

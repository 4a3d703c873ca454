import hashlib

import pytest
from pyspark.sql import functions as F

from placemill.llm import chat
from placemill.llm.queries import ORACLES, QUERIES


def back(df):
    return {r["conv_id"]: r for r in chat.read_chats(chat.format_chats(df)).collect()}


NASTY = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nhi", "\\s\\\\l\\", "a|b<c[d", "", None, "é\n\n<|", "x" * 50_000]


def test_round_trip(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["user", "assistant", "system", "assistant", "a\nb", None, "us<|er", "assistant"], NASTY, strict=True))]
    rows += [(2, 1, "assistant", "tie b"), (2, 1, "assistant", "tie a"), (2, None, "user", "first"), (2, None, "user", "first"), (None, 0, "user", "no id")]
    got = back(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r or "", t or "") for _, _, r, t in rows[:8]]
    assert got[1]["learned"] == NASTY[0 + 1] + NASTY[3] + NASTY[7]
    assert [t["text"] for t in got[2]["turns"]] == ["first", "first", "tie a", "tie b"] and got[2]["learned"] == "tie atie b"
    assert None in got
    body = got[1]["formatted"].replace(chat.OPEN, "").replace(chat.CLOSE, "")
    assert not any(mark in body for mark in ("</s>", "[INST]", "<|", "|>"))


def test_layouts(spark):
    want = [("user", "q"), ("assistant", "a")]
    layouts = {
        "conv_id long, turn long, role string, text string": [(1, 0, "user", "q"), (1, 1, "assistant", "a")],
        "conv_id long, messages array<struct<role: string, content: string>>": [(1, [("user", "q"), ("assistant", "a")])],
        "id long, conversations array<struct<`from`: string, value: string>>": [(1, [("human", "q"), ("gpt", "a")])],
        "id long, prompt string, response string": [(1, "q", "a")],
        "id long, instruction string, input string, output string, extra string": [(1, None, "q", "a", "x")],
    }
    for schema, rows in layouts.items():
        got = back(spark.createDataFrame(rows, schema))
        assert [(t["role"], t["text"]) for t in got[1]["turns"]] == want, schema
        assert got[1]["learned"] == "a"
    prints = {chat.fingerprint(x.paths) for x in chat.LAYOUTS}
    assert len(prints) == len(chat.LAYOUTS)
    with pytest.raises(ValueError, match="no layout"):
        chat.choose_layout(spark.createDataFrame([(1,)], "n long"))


def test_null_arrays_and_empty_table(spark):
    got = back(spark.createDataFrame([(1, None), (2, [])], "conv_id long, messages array<struct<role: string, content: string>>"))
    assert got[1]["formatted"] == got[2]["formatted"] == "" and got[1]["turns"] == []
    assert back(spark.createDataFrame([], "conv_id long, turn long, role string, text string")) == {}


def test_query_equals_sql_and_needs_no_python(spark):
    from compare import connect, rows_of

    sf = "/root/testdata/sf0.001"
    df = QUERIES["op7_chat"](spark, sf)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows_of(df.toPandas()) == rows_of(connect(sf).execute(ORACLES["op7_chat"]).df()[df.columns])
    own = df.where("conv_id = -7").first()
    assert own["loss_sha256"] == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest() and own["n_turns"] == 2
    assert df.where(F.col("formatted_chars") <= F.col("loss_chars")).count() == 0

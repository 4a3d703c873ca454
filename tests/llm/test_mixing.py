import math
import re
from collections import Counter, defaultdict

from placemill.llm import mixing
from placemill.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import awkward, prose, stored, table


def water_fill(sizes):
    """Targets by repeated sharing of the excess."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > 3 * sizes[s]}
        if not full:
            return target | {s: unit * weight[s] for s in free}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


def check(spark, rows, slack):
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = water_fill(sizes)
    got = mixing.repetitions(table(spark, rows)).collect()
    assert len(got) == len(rows)
    taken, largest = Counter(), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], abs_tol=1e-6)
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert math.floor(rate) <= r["copies"] <= math.ceil(rate) <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source in sizes:
        assert abs(taken[source] - want[source]) <= slack * largest[source]
    return got


def test_targets_and_taken_words(spark):
    rows = [(i, prose(5 + i * 7 % 90, i), "en", f"s{min(i % 40, 6)}") for i in range(1500)]
    check(spark, rows, 5)


def test_awkward_rows(spark):
    check(spark, awkward() + [(200, "\x1f\xa0 x y\x0bz", "", "g"), (201, " ", "", "empty")], 3)


def test_reruns_agree_and_rows_are_repeated(spark, tmp_path):
    rows = awkward()
    docs = stored(spark, rows, tmp_path)
    once, again = mixing.mix(docs), mixing.mix(docs)
    assert once.columns == docs.columns
    key = lambda df: sorted(map(str, df.select("doc_id", "text", "source").collect()))
    assert key(once) == key(again)
    copies = Counter()
    for r in mixing.repetitions(docs).collect():
        copies[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in once.collect()) == +copies


def test_empty_table(spark):
    assert mixing.repetitions(table(spark, [])).count() == 0


def test_queries_equal_sql(spark):
    from compare import connect, rows_of

    sf = "/root/testdata/sf0.001"
    for name in ("op8_exact", "op10_mixing"):
        df = QUERIES[name](spark, sf)
        assert rows_of(df.toPandas()) == rows_of(connect(sf).execute(ORACLES[name]).df()[df.columns])

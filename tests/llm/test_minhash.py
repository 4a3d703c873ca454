import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placemill.llm import components as c
from placemill.llm import minhash as m
from placemill.llm.components import components
from tests.llm.helpers import awkward, edited, prose, stored, table


def brute_classes(texts, idf):
    """Class numbers by comparing every pair."""
    words = [m.words(t) for t in texts]
    weighed = [m.weighed(w, idf) for w in words]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            same = words[i] == words[j] or (words[i] and words[j] and m.weighted_jaccard(weighed[i], weighed[j]) >= m.SIMILARITY)
            if same and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def idf_of(texts):
    df = np.zeros(m.DF_SLOTS)
    for t in texts:
        df[np.unique(m._slots(m.word_shingles(m.words(t), m.SHINGLE)[0]))] += 1
    return 1 - m.DAMP * np.minimum(df, len(texts)) / (len(texts) + 100)


def same_partition(a, b):
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


def test_samples_agree_as_often_as_texts_are_alike():
    idf, rng = np.ones(m.DF_SLOTS), random.Random(3)
    for changes in (4, 25):
        exact, agreed = [], []
        for i in range(60):
            text = prose(200, (changes, i).__hash__())
            a, b = m.weighed(text, idf), m.weighed(edited(text, rng.random(), changes), idf)
            exact.append(m.weighted_jaccard(a, b))
            agreed.append(float((m.samples(*a) == m.samples(*b)).mean()))
        assert abs(np.mean(exact) - np.mean(agreed)) < 0.04


def test_weights_count():
    idf = np.ones(m.DF_SLOTS)
    once, thrice = m.weighed("a b c d e", idf), m.weighed("a b c d e a b c d e a b c d e", idf)
    assert 0 < m.weighted_jaccard(once, thrice) < 0.5
    assert m.weighted_jaccard((np.zeros(0, np.uint64), np.zeros(0)), (np.zeros(0, np.uint64), np.zeros(0))) == 1.0


def test_classes_equal_brute_force(spark, tmp_path):
    rows = awkward()
    for family in range(6):  # families of near copies, chained edits, shared passages
        text = prose(80 + 20 * family, 100 + family)
        for copy in range(12):
            rows.append((1000 + 20 * family + copy, edited(text, copy, copy % 4), "en", "a"))
            rows.append((2000 + 20 * family + copy, prose(60, 5000 + 20 * family + copy) + " " + prose(40, 9), "en", "a"))
    rows = [r for r in rows if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    docs = stored(spark, rows, tmp_path)
    got = {r["doc_id"]: r for r in m.near_classes(docs).collect()}
    texts = [r[1] for r in rows]
    want = brute_classes(texts, idf_of(texts))
    assert same_partition([got[r[0]]["class_id"] for r in rows], want)
    for r in got.values():
        members = [x["doc_id"] for x in got.values() if x["class_id"] == r["class_id"]]
        assert r["class_id"] == min(members) and r["class_size"] == len(members) and r["first"] == (r["doc_id"] == min(members))
    kept = m.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted({r["class_id"] for r in got.values()})


@pytest.mark.parametrize("exact", [False, True])
def test_pairs_among_many_texts_of_one_template(spark, tmp_path, exact):
    """1,000 texts that are 0.7 to 0.78 alike, and 15 pairs among them of 0.82 to 0.91: no pick needs to meet them."""
    template, rows, pairs = prose(200, 77), [], []
    for i in range(1000):
        own = prose(16 + i % 4, 9000 + i).split()
        rows.append((i, " ".join([template, *own]), "en", "a"))
        if i % 67 == 0:
            keep = len(own) - 6 - i % 5
            rows.append((5000 + i, " ".join([template, *own[:keep], *prose(len(own) - keep, 20_000 + i).split()]), "en", "a"))
            pairs.append((i, 5000 + i))
    idf = idf_of([r[1] for r in rows])
    weighed = {r[0]: m.weighed(m.words(r[1]), idf) for r in rows}
    alike = [m.weighted_jaccard(weighed[i], weighed[j]) for i in range(40) for j in range(i)]
    assert 0.7 < min(alike) and max(alike) < 0.78
    planted = [m.weighted_jaccard(weighed[a], weighed[b]) for a, b in pairs]
    assert len(pairs) == 15 and 0.82 <= min(planted) and max(planted) <= 0.91
    got = m.near_classes(stored(spark, rows, tmp_path), exact=exact).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {r[0]: r[0] % 5000 for r in rows}


def test_neighbours_are_bounded_and_similar(spark, monkeypatch):
    monkeypatch.setattr(m, "ORDERS", 4)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, (30, m.LONG))
    rows = [(i, i, bytes(np.where(rng.random(m.LONG) < 0.1, 0, base[i % 30]).astype(np.uint8))) for i in range(900)]
    rows += [(900 + i, 7, rows[7][2]) for i in range(300)]  # one class
    sketch = {i: np.frombuffer(k, np.uint8) for i, _, k in rows}
    root = {i: r for i, r, _ in rows}
    got = m.neighbours(spark.createDataFrame(rows, "node long, root long, sketch binary").repartition(5), 0).collect()
    assert 900 < len(got) <= 4 * len(rows)
    assert all(r["a"] < r["b"] and r["root_a"] == root[r["a"]] != root[r["b"]] == r["root_b"] for r in got)
    assert all((sketch[r["a"]] == sketch[r["b"]]).sum() >= m.LONG_AGREEING for r in got)


def test_prefixes_meet_all_similar_pairs(spark):
    texts = [edited(prose(60 + 15 * (i % 5), 400 + i % 3), i, i % 3) for i in range(120)] + ["one", "one", "", "a b c d e f"]
    idf = idf_of(texts)
    broadcast = spark.sparkContext.broadcast(idf)
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    members = frame.where("text <> ''").select(F.col("row").alias("node"), F.col("row").alias("root"))
    got = {(r["a"], r["b"]) for r in m.all_candidates(members, frame, broadcast, m.SIMILARITY).collect()}
    weighed = [m.weighed(m.words(t), idf) for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if texts[i] and texts[j] and m.weighted_jaccard(weighed[i], weighed[j]) >= m.SIMILARITY}
    assert len(want) > 100 and want <= got


def test_repeated_rows_and_nulls(spark, tmp_path):
    docs = stored(spark, awkward(), tmp_path)
    got = m.near_classes(docs).collect()
    assert len(got) == len(awkward())
    blank = [r for r in got if r["doc_id"] in (5, 6, 7)]
    assert {r["class_id"] for r in blank} == {5} and {r["class_size"] for r in blank} == {4}
    assert sum(r["first"] for r in got if r["class_id"] == 10) == 1


def test_empty_table(spark):
    assert m.near_classes(table(spark, [])).count() == 0


@pytest.mark.parametrize("chunk", [7, 1 << 18])
def test_components_of_paths_and_stars(spark, monkeypatch, chunk):
    monkeypatch.setattr(c, "FOREST_EDGES", chunk)  # small chunks leave the components to be joined up by the rounds
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200)]
    random.Random(4).shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = [range(41), range(100, 160), range(200, 202)]
    roots = [{got[i] for i in g} for g in groups]
    assert all(len(r) == 1 and r <= set(g) for r, g in zip(roots, groups, strict=True)) and len(got) == 41 + 60 + 2
    assert components(spark.createDataFrame([(5, 5)], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chunks_are_contracted_to_their_first_nodes(monkeypatch):
    monkeypatch.setattr(c, "FOREST_EDGES", 5)
    draw = random.Random(8)
    a, b = ([draw.randrange(30) for _ in range(23)] for _ in "ab")
    order = {i: draw.random() for i in range(30)}
    batches = [pa.record_batch([pa.array(x[i:i + n]) for x in (a, b, [order[x] for x in a], [order[x] for x in b])], names=list("abcd"))
               for i, n in ((0, 3), (3, 13), (16, 7))]
    chunks = [(0, 3), (3, 8), (8, 13), (13, 16), (16, 21), (21, 23)]
    for (start, end), got in zip(chunks, c._stars(iter(batches)), strict=True):
        group = {x: {x} for x in a[start:end] + b[start:end]}
        for x, y in zip(a[start:end], b[start:end], strict=True):
            for z in (both := group[x] | group[y]):
                group[z] = both
        want = {(x, min(g, key=order.get)) for x, g in group.items() if x != min(g, key=order.get)}
        assert set(zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True)) == want


@pytest.mark.parametrize("block", [16, 1024])
def test_all_pairs_of_shared_buckets_are_compared(spark, monkeypatch, tmp_path, block):
    """With no pair met by picks or neighbours, what is left is linked in full: the classes of all similar pairs that share a bucket."""
    monkeypatch.setattr(m, "BLOCK", block)
    monkeypatch.setattr(m, "candidates", lambda members, turn, every: members.select(*[F.col(x).alias(y) for x, y in (
        ("node", "a"), ("node", "b"), ("root", "root_a"), ("root", "root_b"))]).where("false"))
    monkeypatch.setattr(m, "neighbours", lambda rooted, turn: m.candidates(rooted, turn, True))
    rows = [(i, edited(prose(100, 300 + i % 3), i, i % 4), "en", "a") for i in range(90)]
    got = {r["doc_id"]: r["class_id"] for r in m.near_classes(stored(spark, rows, tmp_path)).collect()}
    texts = [r[1] for r in rows]
    assert same_partition([got[r[0]] for r in rows], brute_classes(texts, idf_of(texts)))

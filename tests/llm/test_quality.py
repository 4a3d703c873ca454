import random
import zlib

import numpy as np

from placemill.llm import quality
from tests.llm.helpers import awkward, prose, table


def corpus():
    rows, labels, rng = [], [], random.Random(5)
    for i in range(300):
        good = i % 3 > 0
        words = prose(80, i).split()
        text = " ".join(w + ("." if j % 9 == 8 else "") for j, w in enumerate(words)) if good else rng.choice([
            " ".join(w + "###" for w in words), (words[0] + " ") * 80, "\n".join([" | ".join(words[:5])] * 20), "!! ".join(words).upper()])
        rows.append((i, text, "en", "a"))
        labels.append((i, int(good), 0))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, text int")


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    got = {r["doc_id"]: r for r in quality.judge(table(spark, rows), labelled(spark, labels)).collect()}
    held = [(i, q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] for i, _ in held) and sum(r["held_out"] for r in got.values()) == len(held)
    assert sum(got[i]["predicted"] == q for i, q in held) >= 0.97 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got.values())


def test_moments_equal_numpy(spark):
    rows, labels = corpus()
    vectors = quality._vectors([t for _, t, *_ in rows])
    df = spark.createDataFrame([(v.tolist(), q) for v, (_, q, _) in zip(vectors, labels, strict=True)], "vector array<double>, quality int")
    model = quality.fit(df)
    own = vectors[[q == 1 for _, q, _ in labels]]
    assert np.allclose(model.classes[1][0], own.mean(0))
    cov = np.cov(own.T, bias=True)
    want = (1 - quality.SHRINKAGE) * (cov + quality.FLOOR * np.eye(len(cov))) + quality.SHRINKAGE * np.diag(np.diag(cov) + quality.FLOOR)
    factor = np.linalg.inv(model.classes[1][1])
    assert np.allclose(factor @ factor.T, want)


def test_awkward_rows(spark):
    rows, labels = corpus()
    labels += [(None, 1, 0), (5000, 1, 0), (0, None, 0), (1, 7, 0), (2, 1, 0), (2, 1, 0)]
    got = quality.judge(table(spark, rows + [(None if d is None else d + 1000, *x) for d, *x in awkward()]), labelled(spark, labels)).collect()
    assert len(got) == 300 + len(awkward()) and all(0 <= r["score"] <= 1 for r in got)


def test_no_labels_and_empty_table(spark):
    none = labelled(spark, [])
    assert [(r["score"], r["predicted"]) for r in quality.judge(table(spark, [(1, "x", "", "")]), none).collect()] == [(0.5, 0)]
    assert quality.judge(table(spark, []), none).count() == 0


def test_scores_equal_the_normal_densities(spark):
    """Posteriors from determinants and inverses of the shrunken covariances, without factors."""
    rows, labels = corpus()
    known = [(v, q) for (i, t, *_), (_, q, _) in zip(rows, labels, strict=True) for v in [np.array(quality.statistics(t))] if zlib.crc32(str(i).encode()) % 4 != 2]
    logs = []
    for label in (0, 1):
        own = np.array([v for v, q in known if q == label])
        cov = np.cov(own.T, bias=True)
        cov = (1 - quality.SHRINKAGE) * (cov + quality.FLOOR * np.eye(len(cov))) + quality.SHRINKAGE * np.diag(np.diag(cov) + quality.FLOOR)
        inverse, det, prior = np.linalg.inv(cov), np.linalg.slogdet(cov)[1], np.log(len(own) / len(known))
        logs.append(lambda v, m=own.mean(0), inverse=inverse, det=det, prior=prior: prior - 0.5 * (det + (v - m) @ inverse @ (v - m)))
    for r in quality.judge(table(spark, rows), labelled(spark, labels)).collect():
        v = np.array(quality.statistics(dict((i, t) for i, t, *_ in rows)[r["doc_id"]]))
        assert np.isclose(r["score"], 1 / (1 + np.exp(np.clip(logs[0](v) - logs[1](v), -700, 700))), atol=1e-5)


def test_other_scripts_have_letters_too():
    feature = {name: i for i, name in enumerate(quality.FEATURES)}
    for text in ("Это обычный русский текст, без знаков.", "Αυτό είναι ένα κείμενο, χωρίς σημεία.", "これは普通の文章です、記号はありません。", "𐐨𐐩𐐪 𐐫𐐬 𐐭."):
        letters, marks = (quality.statistics(text * 20)[feature[f]] for f in ("letters", "other marks"))
        assert letters > 0.8 and marks < 0.1, text
    assert quality.statistics("“Curly” – dashes…")[feature["other marks"]] > quality.statistics("Curly dashes")[feature["other marks"]]

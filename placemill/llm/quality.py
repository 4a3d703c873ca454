"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Each text becomes a vector of ``len(FEATURES)`` statistics, logarithms and stabilised fractions. Counts, sums and products
per class are added up over all labelled rows; class covariances are shrunk toward their diagonal, and their Cholesky
factors are kept in the model. A score is the posterior of class 1: the logistic of the difference of the two
classes' log densities (Mahalanobis distance, determinant, prior).

Defined results: a NULL or empty text has the statistics of the empty text and is scored like any other; labels NULL or
other than 0 and 1 are not learned from, nor are rows with a NULL doc_id; a document labelled more than once is
learned once per label; with no label of a class the score is 0.5; repeated rows are scored alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm.common import map_batches, schema_text
from placemill.session import stable

SHRINKAGE = 0.1   # weight of the diagonal target in each class covariance
FLOOR = 1e-3      # added to each variance
THRESHOLD = 0.7
USUAL = 8           # usual cases added to each fraction

FEATURES = (
    "word length", "letters", "capitals", "digits", "stops and commas", "other marks", "white space",
    "distinct words", "repeated neighbours", "distinct lines", "short words", "marked words", "words per stop",
)
_SENTENCE_END = re.compile(r"[.!?]+(?=\s|$)")

# fixed values: stops and commas, also of scripts that have their own
_STOPS = ".,。、．，؛،।"


def _kind(c: str) -> int:
    """Letter, capital, digit, stop or comma, other mark, white space; by Unicode category."""
    if c.isspace():
        return 5
    category = unicodedata.category(c)
    if category[0] in "LM":
        return 1 if category in {"Lu", "Lt"} else 0
    return 2 if category == "Nd" or c.isdigit() else 3 if c in _STOPS else 4


@lru_cache(1)
def _kinds() -> np.ndarray:
    """The kind of each code point of the basic plane."""
    return np.array([_kind(chr(c)) for c in range(1 << 16)], np.int64)


def _kind_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    basic = codes < 1 << 16
    counts = np.bincount(_kinds()[codes[basic]], minlength=6)
    if not basic.all():
        found, times = np.unique(codes[~basic], return_counts=True)
        counts += np.bincount([_kind(chr(c)) for c in found], times, 6).astype(np.int64)
    return counts


def _part(some: int, of: int, usual: float) -> float:
    """A fraction with a few usual cases added, so that a short text says little; the root evens out its variance."""
    return float(np.sqrt(min(1.0, (some + USUAL * usual) / (of + USUAL))))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text."""
    text = text or ""
    kinds = _kind_counts(text)
    n = len(text) + 1
    words = text.split()
    n_words = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    lower, capital, digit, stop, other, space = (int(k) for k in kinds)
    distinct = len(set(words))
    same = sum(a == b for a, b in pairwise(words))
    stops = len(_SENTENCE_END.findall(text))
    return [
        float(np.log1p((n - 1 - space) / max(1, n_words))),
        _part(lower + capital, n, 0.8), _part(capital, lower + capital, 0.03), _part(digit, n, 0.0), _part(stop, n, 0.03),
        _part(other, n, 0.0), _part(space, n, 0.16),
        _part(distinct, n_words, 1.0), _part(same, n_words, 0.0), _part(len(set(lines)), len(lines), 1.0),
        _part(sum(len(w) <= 3 for w in words), n_words, 0.3), _part(sum(not w[-1].isalnum() for w in words), n_words, 0.12),
        _part(stops, n_words, 0.1),
    ]


def _vectors(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(-1, len(FEATURES))


class Discriminant:
    """Two Gaussian classes from their counts, sums and sums of products."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        self.classes = []
        if set(moments) != {0, 1}:
            return
        total = sum(n for n, _, _ in moments.values())
        for label in (0, 1):
            n, sums, products = moments[label]
            mean = sums / n
            cov = products / n - np.outer(mean, mean)
            target = np.diag(np.diag(cov) + FLOOR)
            factor = np.linalg.cholesky((1 - SHRINKAGE) * (cov + FLOOR * np.eye(len(mean))) + SHRINKAGE * target)
            self.classes.append((mean, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(), np.log(n / total)))

    def score(self, vectors: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(vectors), 0.5)
        density = []
        for mean, inverse, log_det, log_prior in self.classes:
            whitened = (vectors - mean) @ inverse.T
            density.append(log_prior - 0.5 * (log_det + (whitened ** 2).sum(1)))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _rows(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def vectors(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` with the statistics of each text as ``vector``."""
    rows = docs.select(*columns, F.col("text").cast("string").alias("_text"))
    kept = rows.schema.fields[:-1]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([*batch.columns[:-1], _rows(_vectors(batch.column(len(kept)).to_pylist()))],
                               names=[*[f.name for f in kept], "vector"])

    return map_batches(rows, each, f"{schema_text(rows.drop('_text'))}, vector array<double>")


def _moment_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    matrix, labels = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
    found = [k for k in (0, 1) if (labels == k).any()]
    rows = [matrix[labels == k] for k in found]
    flat = [np.concatenate([x.sum(0), (x.T @ x).ravel()]) for x in rows]
    return pa.record_batch([
        pa.array(found, pa.int32()), pa.array([len(x) for x in rows], pa.int64()), pa.array(flat, pa.list_(pa.float64())),
    ], names=["label", "n", "sums"])


def fit(labelled: DataFrame) -> Discriminant:
    """A model from rows (vector, quality). One row per class reaches the driver."""
    rows = labelled.where(F.col("quality").isin(0, 1)).select("vector", F.col("quality").cast("int"))
    parts = map_batches(rows, _moment_batch, "label int, n long, sums array<double>")
    d = len(FEATURES)
    summed = parts.groupBy("label").agg(F.sum("n"), *[F.sum(F.col("sums")[i]) for i in range(d + d * d)])
    moments = {}
    for label, n, *flat in summed.collect():
        moments[label] = (n, np.array(flat[:d]), np.array(flat[d:]).reshape(d, d))
    return Discriminant(moments)


def score(measured: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``measured`` with score and predicted in place of their vector."""
    shared = measured.sparkSession.sparkContext.broadcast(model)
    names = [c for c in measured.columns if c != "vector"]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.score(_matrix(batch.column(len(names))))
        return pa.record_batch([*batch.columns[:-1], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                               names=[*names, "score", "predicted"])

    rest = measured.drop("vector")
    return map_batches(measured.select(*rest.columns, "vector"), each, f"{schema_text(rest)}, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """Learn from labelled documents whose crc32 remainder differs, score all: doc_id, held_out, score, predicted.

    Statistics are taken once and written; labels join the narrow table."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))
    measured = stable(vectors(docs.withColumn("held_out", out), ("doc_id", "held_out")), "vectors")
    marks = labels.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_labelled"), "quality")
    learned = measured.where("NOT held_out").join(marks, F.col("doc_id") == F.col("_labelled"))
    return score(measured, fit(learned))

"""Language ID: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased letters with one space for everything else. The n-grams of one to three characters are hashed to
``SLOTS`` columns; counts per language make a matrix of log probabilities (languages x slots, fixed width), which is
broadcast. A batch of texts is scored sparsely, from its distinct pairs of text and slot. A score is the posterior probability of the language predicted.

The model is fitted on ``TRAIN_DOCS`` labelled documents at most, chosen by a hash of doc_id.

Defined results: a NULL text or one without letters is ``und`` with score 0, as is everything when no label was seen;
ties go to the language first by name; rows with a NULL doc_id or NULL lang are not learned from; repeated rows are
scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.llm.common import map_batches, schema_text

SLOTS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
TRAIN_DOCS = 20_000
UNKNOWN = "und"
PIECE = 1 << 18  # pairs of text and slot scored at a time

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case code point of each letter of the basic plane, 32 for all else."""
    out = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            out[c] = ord(ch.lower()[0])
    return out


def _normalised(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    basic = codes < 1 << 16
    out = _letters()[np.where(basic, codes, 32)]
    if not basic.all():
        for i in np.flatnonzero(~basic):
            out[i] = codes[i] if chr(codes[i]).isalpha() else 32
    gap = out == 32
    if not (~gap).any():
        return out[:0]
    gap[1:] &= gap[:-1]
    out = out[~gap]
    return np.concatenate([np.array([32], np.uint32), out[int(out[0] == 32):], np.array([32], np.uint32)])


def gram_slots(text: str | None) -> np.ndarray:
    """Slots of all n-grams of a text; empty if it has no letter."""
    codes = _normalised(text) if text else np.zeros(0, np.uint32)
    if not len(codes):
        return np.zeros(0, np.int64)
    wide = codes.astype(np.uint64)
    grams = []
    for order in ORDERS:
        n = len(wide) - order + 1
        if n > 0:
            h = np.full(n, order, np.uint64)
            for i in range(order):
                h = (h ^ wide[i:i + n]) * _MULTIPLIERS[i]
            grams.append((h ^ (h >> np.uint64(29))) * _MULTIPLIERS[0] >> np.uint64(49))
    return np.concatenate(grams).astype(np.int64)


assert SLOTS == 1 << (64 - 49)


def held_out(modulus: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0, F.lit(False))


def _count_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts: dict[str, np.ndarray] = {}
    for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        slots = gram_slots(text)
        if len(slots):
            if lang not in counts:
                counts[lang] = np.zeros(SLOTS, np.int64)
            counts[lang] += np.bincount(slots, minlength=SLOTS)
    langs, slots, n = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lang, row in counts.items():
        found = np.flatnonzero(row)
        langs += [lang] * len(found)
        slots.append(found)
        n.append(row[found])
    return pa.record_batch([pa.array(langs, pa.string()), pa.array(np.concatenate(slots)), pa.array(np.concatenate(n))],
                           names=["lang", "slot", "n"])


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = counts + SMOOTHING
        self.log_p = np.log(smooth / smooth.sum(1, keepdims=True)) if langs else None

    def likelihoods(self, slots: Iterable[np.ndarray]) -> np.ndarray:
        """The log likelihood of each text (rows) in each language. A batch is its distinct (text, slot) pairs with their counts; per
        language their log probabilities are gathered, weighed and added up by text, ``PIECE`` pairs at a time."""
        distinct, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for own in slots:  # of a text's n-grams no more is held than its pairs
            counts = np.bincount(own)
            distinct.append(np.flatnonzero(counts))
            times.append(counts[distinct[-1]])
        owner = np.repeat(np.arange(len(distinct) - 1), [len(d) for d in distinct[1:]])
        flat, weight = np.concatenate(distinct), np.concatenate(times)
        out = np.zeros((len(distinct) - 1, len(self.langs)))
        for i in range(0, len(flat), PIECE):
            own, slot, n = owner[i:i + PIECE], flat[i:i + PIECE], weight[i:i + PIECE]
            starts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
            for k in range(len(self.langs)):
                out[own[starts], k] += np.add.reduceat(self.log_p[k][slot] * n, starts)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        found = self.likelihoods(map(gram_slots, texts)) if self.langs else ()
        for i, likelihood in enumerate(found):
            if likelihood.any():  # a text with letters has an n-gram, whose probability is below 1
                best = int(likelihood.argmax())
                names[i] = self.langs[best]
                scores[i] = float(1 / np.exp(likelihood - likelihood[best]).sum())
        return names, scores


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """A model from rows (doc_id, text, lang); rows with a NULL among doc_id and lang are left out. The matrix that
    reaches the driver has a fixed number of slots per language."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    n = max(1, rows.count())
    share = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) < int(min(1.0, train_docs / n) * (1 << 30))
    grams = map_batches(rows.where(share).select(F.col("text").cast("string"), F.col("lang").cast("string")),
                        _count_batch, "lang string, slot long, n long")
    summed = grams.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(summed["lang"].unique())
    counts = np.zeros((len(langs), SLOTS))
    place = {lang: i for i, lang in enumerate(langs)}
    counts[summed["lang"].map(place).to_numpy(np.int64), summed["slot"].to_numpy(np.int64)] = summed["n"]
    return Model(langs, counts)


def predict(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*columns, F.col("text").cast("string").alias("_text"))
    kept = rows.schema.fields[:-1]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = shared.value.predict(batch.column(len(kept)).to_pylist())
        return pa.record_batch([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                               names=[*[f.name for f in kept], "lang_pred", "score"])

    return map_batches(rows, each, f"{schema_text(rows.drop('_text'))}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents, all columns, whose language is predicted with a score of at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    position = docs.columns.index("text")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = shared.value.predict(batch.column(position).to_pylist())
        return batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(langs, scores, strict=True)], pa.bool_()))

    return map_batches(docs, each, schema_text(docs))


def identify(docs: DataFrame, modulus: int = 5) -> DataFrame:
    """Learn from documents whose crc32 remainder is not 0, predict all: doc_id, held_out, lang_pred, score."""
    model = fit(docs.where(~held_out(modulus)).select("doc_id", "text", "lang"))
    return predict(docs.withColumn("held_out", held_out(modulus)), model, ("doc_id", "held_out"))

"""Ranked lexical search: exact inner-product search in ball trees over sparse document vectors.

A document is the vector of its terms' integer values (1e9 tf) div (1000 tf + 20 m), an item the vector of its terms' integer
weights; the score is their inner product. Documents are read in blocks of at most ``BLOCK_DOCS`` rows or ``BLOCK_VALUES``
values. Each block becomes a ball tree: a node holds a centre and radii that all its documents lie within, and is halved along
the line between two far documents. Terms are put in groups by the subtree, ``GROUP_DEPTH`` levels down, in which they weigh
most, and a node has one radius per group: a document of one language has next to nothing in the terms of another, which a
single radius would not tell. An item walks the tree best-first: a node's bound is centre times item plus, over the groups,
radius times the item's length. Bounds are floats, made a little too large for every rounding on the way (``SLACK``), and a
subtree is left out only if its bound is below the score that the item's results already have to reach; leaves are scored in
64-bit integers. So results are exact. Geometry uses coordinates scaled by the root of the term's weight, on both sides alike.

What the results have to reach is kept per task from block to block, and starts from the scores that the same search finds
in about ``FLOOR_DOCS`` documents drawn by hash, a true lower bound that changes no result.

Only terms of the items take part, since others have no weight. Items are a stated query set; they are taken in blocks of
at most ``ITEMS`` rows and ``ITEM_BYTES`` of text (one longer item is a block of its own), and a block's terms are what
is broadcast. Documents are read in place, without a shuffle; what meets is 50 rows per item and task, first in ``SALTS`` groups.

Defined results: a NULL or empty text has no terms, and neither matches nor counts; an item without matching documents has no
rows; rows with equal item_id are ranked one by one; equal scores are ordered by doc_id, NULL last; repeated documents are ranked
one by one; no documents or no items give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill.llm.common import map_batches, stream_batches
from placemill.session import stable

TOP = 50
BLOCK_DOCS, BLOCK_VALUES = 16_384, 2_000_000
LEAF_DOCS = 128
GROUP_DEPTH = 7     # up to 128 groups of terms
CENTRE_VALUES = 16_000_000  # numbers in all centres of a tree; larger vocabularies get larger leaves
ITEMS, ITEM_BYTES = 5_000, 2 << 20
FLOOR_DOCS = 20_000
SALTS = 64
SLACK = 1e-9

# fixed values: terms are runs of ASCII letters and digits and of everything beyond ASCII; A-Z are lower-cased
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_VECTORS = "doc_id long, n long, terms array<int>, tfs array<long>"
_FOUND = "item int, item_id long, doc_id long, score long, task int"


def terms(text: str | None) -> list[bytes]:
    """All terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


# ---- vectors ---------------------------------------------------------------------------------------------
def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): the number of all terms, and the counts of those in the vocabulary by number. Documents
    without terms are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        number = shared.value.get
        kept, sizes, lengths, found, counts = [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            own = terms(text)
            if own:
                known = np.array([t for t in map(number, own) if t is not None], np.int32)
                known, tfs = np.unique(known, return_counts=True)
                kept.append(i)
                sizes.append(len(own))
                lengths.append(len(known))
                found.append(known)
                counts.append(tfs)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
        join = lambda x, kind: pa.array(np.concatenate(x) if x else [], kind)
        return pa.record_batch([
            batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(offsets, join(found, pa.int32())), pa.ListArray.from_arrays(offsets, join(counts, pa.int64()))],
            names=["doc_id", "n", "terms", "tfs"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), each, _VECTORS)


def weights(documents: int, frequencies: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64)


def values(tf: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, documents: int, length: int) -> np.ndarray:
    """The integer values of documents of ``sizes`` terms, ``lengths`` of which follow each other in ``tf``."""
    if 50 * int(sizes.max(initial=0)) * documents >= 1 << 63:
        m = np.array([50 + 50 * n * documents // length for n in sizes.tolist()], np.int64)
    else:
        m = 50 + 50 * sizes * documents // length
    return 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, lengths))


# ---- the tree --------------------------------------------------------------------------------------------
class BallTree:
    """A tree over rows (doc, null, terms, values), given as flat terms and values with the rows' offsets."""

    def __init__(self, docs: np.ndarray, nulls: np.ndarray, offsets: np.ndarray, flat_terms: np.ndarray, flat_values: np.ndarray,
                 weight: np.ndarray):
        self.vocabulary, self.root = len(weight), np.sqrt(weight.astype(np.float64))
        n = len(docs)
        least = max(LEAF_DOCS, -(-2 * n * self.vocabulary // CENTRE_VALUES))
        self.docs, self.nulls, self.offsets, self.terms, self.values = docs, nulls, offsets, flat_terms, flat_values
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        waiting, frontier = [(0, n, -1, 0)], []
        while waiting:
            start, end, parent, depth = waiting.pop()
            node = len(self.spans)
            self.spans.append((start, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            halved = end - start > least and self._halve(start, end)
            if halved:
                middle = (start + end) // 2
                waiting += [(start, middle, node, depth + 1), (middle, end, node, depth + 1)]
            if depth == GROUP_DEPTH or depth < GROUP_DEPTH and not halved:
                frontier.append(node)
        self.groups = len(frontier)
        mass = np.stack([np.bincount(own, x * x, self.vocabulary) / len(rows) for rows, own, x in (self._part(*self.spans[f]) for f in frontier)])
        self.group = np.argmax(mass, 0)
        self.radii, self.centres = [], []
        for start, end in self.spans:
            self._ball(start, end)

    def _part(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row starts, terms and scaled coordinates of the rows from start to end."""
        a, b = self.offsets[start], self.offsets[end]
        own = self.terms[a:b]
        return self.offsets[start:end] - a, own, self.values[a:b] * self.root[own]

    def _ball(self, start: int, end: int) -> None:
        """Add a node's centre and, for each group of terms, a radius that is not too small."""
        rows, own, x = self._part(start, end)
        n, k = end - start, self.groups
        centre = (np.bincount(own, x, self.vocabulary) / n).astype(np.float32)
        c = centre.astype(np.float64)
        c2 = np.bincount(self.group, c * c, k)
        cell = np.repeat(np.arange(n) * k, np.diff(np.append(rows, len(own)))) + self.group[own]
        length2 = np.bincount(cell, x * x, n * k).reshape(n, k).max(0)
        far = (np.bincount(cell, x * x - 2 * x * c[own], n * k).reshape(n, k) + c2).max(0)
        self.centres.append(centre)
        self.radii.append(np.sqrt(np.maximum(far, 0) + SLACK * (length2 + c2)))

    def _halve(self, start: int, end: int) -> bool:
        """Order the rows along the line between two far ones; not if all are alike."""
        rows, own, x = self._part(start, end)
        length2 = np.add.reduceat(x * x, rows)

        def products(row: int) -> np.ndarray:
            dense = np.zeros(self.vocabulary)
            a = rows[row]
            b = rows[row + 1] if row + 1 < len(rows) else len(own)
            dense[own[a:b]] = x[a:b]
            return np.add.reduceat(x * dense[own], rows)

        one = int(np.argmax(length2 - 2 * products(0) + length2[0]))
        to_one = products(one)
        other = int(np.argmax(length2 - 2 * to_one + length2[one]))
        along = to_one - products(other)
        if one == other or float(along.min()) == float(along.max()):
            return False
        order = np.argsort(along, kind="stable")
        lengths = np.diff(np.append(rows, len(own)))[order]
        base = self.offsets[start]
        take = np.repeat(rows[order] - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(own))
        self.terms[base:base + len(own)] = own[take]
        self.values[base:base + len(own)] = self.values[base:base + len(own)][take]
        self.docs[start:end], self.nulls[start:end] = self.docs[start:end][order], self.nulls[start:end][order]
        self.offsets[start:end] = base + np.cumsum(lengths) - lengths
        return True

    def search(self, item_terms: np.ndarray, item_weights: np.ndarray, best: Best, dense: np.ndarray) -> int:
        """Merge the documents of this tree into ``best``; the number of leaves scored. ``dense`` is an array of zeros over
        the vocabulary, and is handed back as such."""
        q = self.root[item_terms]
        q_lengths = np.sqrt(np.bincount(self.group[item_terms], q * q, self.groups))
        dense[item_terms] = item_weights
        scored = 0

        def bound(node: int) -> float:
            return (float(self.centres[node][item_terms] @ q) + float(q_lengths @ self.radii[node])) * (1 + SLACK) + 1

        heap = [(-bound(0), 0)]
        while heap:
            upper, node = heapq.heappop(heap)
            if -upper < best.needed:
                break
            if self.children[node]:
                for child in self.children[node]:
                    of = bound(child)
                    if of >= best.needed:
                        heapq.heappush(heap, (max(-of, upper), child))
                continue
            start, end = self.spans[node]
            a, b = self.offsets[start], self.offsets[end]
            scores = np.add.reduceat(self.values[a:b] * dense[self.terms[a:b]], self.offsets[start:end] - a)
            scored += 1
            hits = np.flatnonzero(scores >= best.needed)
            if len(hits):
                best.add(scores[hits], self.docs[start:end][hits], self.nulls[start:end][hits])
        dense[item_terms] = 0
        return scored


class Best:
    """The highest scores of one item, and the score that a further document has to reach."""

    def __init__(self, floor: int = 1, top: int = TOP):
        self.needed, self.top = max(floor, 1), top
        self.scores, self.docs, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, docs: np.ndarray, nulls: np.ndarray) -> None:
        scores, docs, nulls = np.append(self.scores, scores), np.append(self.docs, docs), np.append(self.nulls, nulls)
        order = np.lexsort((docs, nulls, -scores))[:self.top]
        self.scores, self.docs, self.nulls = scores[order], docs[order], nulls[order]
        if len(order) == self.top:
            self.needed = max(self.needed, int(self.scores[-1]))


# ---- search over tables ----------------------------------------------------------------------------------
def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(docs, nulls, sizes, lengths, terms, tfs) of so many documents as a tree may hold; only those that share a term
    with an item."""
    held, rows, flat = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            lengths = part.column(2).value_lengths().to_numpy()
            kept = lengths > 0
            doc = part.column(0)
            held.append((doc.fill_null(0).to_numpy()[kept], doc.is_null().to_numpy(zero_copy_only=False)[kept], part.column(1).to_numpy()[kept],
                         lengths[kept], part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()))
            rows, flat = rows + int(kept.sum()), flat + int(lengths.sum())
            if rows >= BLOCK_DOCS or flat >= BLOCK_VALUES:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, rows, flat = [], 0, 0
    if rows:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def search(vectors: DataFrame, items: list[tuple[int | None, list[int]]], weight: np.ndarray, documents: int, length: int,
           floors: dict[int, int], top: int = TOP) -> DataFrame:
    """(item, item_id, doc_id, score, task): the best documents of each task for each item (item_id, term numbers)."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, weight, floors))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, floors = shared.value
        best = [Best(floors.get(i, 1), top) for i in range(len(items))]
        own = [np.array(t, np.int64) for _, t in items]
        dense = np.zeros(len(weight), np.int64)
        for docs, nulls, sizes, lengths, found, tfs in _blocks(batches):
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            tree = BallTree(docs.copy(), nulls.copy(), offsets, found.astype(np.int64), values(tfs, lengths, sizes, documents, length), weight)
            for i, t in enumerate(own):
                if len(t):
                    tree.search(t, weight[t], best[i], dense)
        task = TaskContext.get().partitionId()
        for i, b in enumerate(best):
            if n := len(b.scores):
                yield pa.record_batch([
                    pa.array(np.full(n, i, np.int32)), pa.array([items[i][0]] * n, pa.int64()), pa.array(b.docs, mask=b.nulls),
                    pa.array(b.scores), pa.array(np.full(n, task, np.int32))], names=["item", "item_id", "doc_id", "score", "task"])

    return stream_batches(vectors, each, _FOUND)


def merged(found: DataFrame, top: int = TOP) -> DataFrame:
    """(item, item_id, rank, doc_id, score) of the best of all tasks."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("item", F.pmod("task", F.lit(SALTS))).orderBy(*order)
    first = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("item", "item_id", "rank", "doc_id", "score")


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        own = sorted(set(terms(row["text"])))
        more = sum(map(len, own))
        if block and (len(block) >= ITEMS or size + more > ITEM_BYTES):
            yield block
            block, size = [], 0
        block.append((row["item_id"], own))
        size += more
    if block:
        yield block


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents (doc_id, text) with the highest scores for each item (item_id, text)."""
    spark = docs.sparkSession
    results = [spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")]
    for number, block in enumerate(_item_blocks(items)):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in block for t in own}))}
        vectors = stable(term_counts(docs, vocabulary), f"vectors-{number}")
        documents, length = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            continue
        frequencies = np.zeros(len(vocabulary), np.int64)
        for term, df in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            frequencies[term] = df
        weight = weights(documents, frequencies)
        numbered = [(item_id, [vocabulary[t] for t in own]) for item_id, own in block]
        drawn = vectors.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(max(1, documents // FLOOR_DOCS))) == 0)
        reached = merged(search(drawn, numbered, weight, documents, length, {}, top), top).where(F.col("rank") == top)
        floors = {r["item"]: r["score"] for r in reached.select("item", "score").toLocalIterator()}
        found = merged(search(vectors, numbered, weight, documents, length, floors, top), top)
        results.append(stable(found, f"ranked-{number}").select("item_id", "rank", "doc_id", "score"))
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out

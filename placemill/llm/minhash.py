"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

* A text is its lower-cased words between white space; shingles are runs of ``SHINGLE`` words. The weight of a shingle is
  its count in the text times an inverse document frequency 1 - DAMP * df / (N + 100). A logarithmic frequency would
  break up large families of near copies, since the edits are just their rarest shingles; this one only takes weight
  from what a large part of the corpus shares. Document frequencies are counted over all documents in
  ``DF_SLOTS`` hashed slots, a table of fixed size that is broadcast.
* ``BANDS * ROWS`` samples per text by improved consistent weighted sampling: two texts agree in a sample with a probability
  of their weighted Jaccard similarity. Random numbers come from one table, picked by a hash of shingle and sample.
* Texts that are equal word for word are folded to one. Texts meet in buckets of one band, and in finer ones of two.
* In each round every bucket that still spans several classes picks one member by hash, and those of other classes are compared
  with it. First, for ``QUICK_ROUNDS``, each text is compared with the pick of its finest buckets only, then with the
  picks of all of them: never more pairs than members. Pairs whose samples agree in fewer than ``LEAST_AGREEING`` places are given up
  (at a similarity of 0.8 that happens once in ten million), the others are verified by their exact weighted
  Jaccard similarity. Linked classes become one, buckets inside one class are done, and rounds go on until one over all
  picks finds few links or none (``PAYING``). So no bucket is capped, and none emits all its pairs.
* What then still lies in a bucket of several classes gets a second, longer sketch of ``LONG`` samples. In each further round
  these texts are sorted by their sketches under ``ORDERS`` permutations of the samples, by range partitions, so that no
  key is hot; similar texts share long beginnings and lie close together. Each is compared with the ``REACH`` texts before it by
  sketch, and the one of another class that agrees best, in ``LONG_AGREEING`` places at least, is verified: never more pairs than
  ``ORDERS`` times the texts, whatever their groups. This is done once.
* What is left in buckets of several classes is compared in full: texts that hang together by such buckets are one group, a group is
  dealt into blocks of about ``BLOCK`` texts, and each two blocks meet in a task, which compares every pair of texts of different classes
  that share a bucket, by sketch and then by text, and contracts what it links. So no pair of a shared bucket is left out, whatever the
  rounds before have met. Memory is that of two blocks; only links leave a task. The time is the square of the texts of a group that
  share a bucket with another class.
* With ``exact`` a join on prefixes follows, which leaves no pair to chance among texts that share a bucket with another class: of
  two texts at least ``SIMILARITY`` alike, each can miss only a share of its weight in the other, so with the shingles of both in
  one order, rarest first, their first common shingle lies within that share. It emits all pairs that meet so, the square of the
  number of texts that share their rarest shingles, and is therefore left to the caller.

Defined results: NULL, empty and white-space texts are equal to each other; a text of fewer words than a shingle is one
shingle; repeated rows are members of one class; a class is named by its smallest doc_id (NULL if it has none); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm.common import keep_rows, map_batches, numbered, stream_batches
from placemill.llm.components import components
from placemill.llm.shingles import word_shingles
from placemill.session import stable

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
LEAST_AGREEING = 14
DAMP = 0.5
DF_SLOTS = 1 << 16
ORDER_SLOTS = 1 << 20  # slots of the counts that order shingles by rarity
QUICK_ROUNDS = 3  # rounds that compare each text with one pick only, before those that compare it with all

LONG, LONG_AGREEING = 192, 140  # samples of the second sketch, and places to agree in (at 0.8 one pair in a hundred has fewer)
ORDERS, REACH = 12, 128
BLOCK = 1024  # texts of a group that meet those of another block in a task

_SAMPLES = BANDS * ROWS
_TABLE_BITS = 14
PAYING = 20  # rounds over all picks go on while more than one in so many of their pairs is a link
_SLACK = 1e-9  # for sums of weights in another order
_PIECE = 4096  # shingles sampled at a time


def words(text: str | None) -> str:
    return " ".join((text or "").lower().split())


# ---- weights ---------------------------------------------------------------------------------------------
def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(DF_SLOTS - 1)).astype(np.int64)


def _df_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts = np.zeros(DF_SLOTS, np.int64)
    for text in batch.column(0).to_pylist():
        counts[np.unique(_slots(word_shingles(words(text), SHINGLE)[0]))] += 1
    found = np.flatnonzero(counts)
    return pa.record_batch([pa.array(found), pa.array(counts[found])], names=["slot", "n"])


def document_shares(texts: DataFrame) -> np.ndarray:
    """Of each slot, the factor that its shingles' counts are weighed by; DF_SLOTS rows reach the driver."""
    counted = map_batches(texts.select("text"), _df_batch, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    df, n = np.zeros(DF_SLOTS), texts.count()
    for slot, count in counted.collect():
        df[slot] = count
    return 1 - DAMP * np.minimum(df, n) / (n + 100)


def weighed(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of normalised words, and their weights."""
    shingles, counts = word_shingles(text, SHINGLE)
    return shingles, counts * idf[_slots(shingles)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller over sum of the larger weights; two texts without shingles are alike."""
    _, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][in_a], b[1][in_b]).sum()
    total = a[1].sum() + b[1].sum() - both
    return float(both / total) if total else 1.0


# ---- samples ---------------------------------------------------------------------------------------------
@lru_cache(2)
def _random_tables(count: int) -> tuple[np.ndarray, ...]:
    draw = np.random.Generator(np.random.PCG64(20240229))
    n = 1 << _TABLE_BITS
    r = draw.gamma(2.0, 1.0, n).astype(np.float32)
    log_c = np.log(draw.gamma(2.0, 1.0, n)).astype(np.float32)
    beta = draw.random(n).astype(np.float32)
    return r, log_c, beta, draw.integers(1 << 62, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)


def samples(shingles: np.ndarray, weights: np.ndarray, count: int = _SAMPLES) -> np.ndarray:
    """The consistent samples of a text: of each, the least value over its shingles above, which shingle below. The
    value also tells the quantised weight, so equal numbers are equal (shingle, weight) samples."""
    r_of, log_c_of, beta_of, multipliers = _random_tables(count)
    best = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _PIECE):
        h = shingles[i:i + _PIECE, None] * multipliers
        pick = (h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        r, beta = r_of[pick], beta_of[pick]
        t = np.floor(np.log(weights[i:i + _PIECE, None]).astype(np.float32) / r + beta)
        value = log_c_of[pick] - r * (t - beta + np.float32(1)) + np.float32(128)  # above 0, where floats order like integers
        key = (value.astype(np.float64).view(np.uint64) & np.uint64(0xFFFFFFFF00000000)) | (h >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
        np.minimum(best, key.min(0), out=best)
    return best


def signatures(texts: DataFrame, idf) -> DataFrame:
    """(row, same, sample): ``same`` is equal for texts that are equal word for word; no samples without words."""
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        same, rows = [], []
        for text in batch.column(1).to_pylist():
            text = words(text)
            same.append(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            rows.append(samples(*weighed(text, idf.value)).view(np.int64) if text else None)
        return pa.record_batch([batch.column(0), pa.array(same, pa.binary()), pa.array(rows, pa.list_(pa.int64()))],
                               names=["row", "same", "sample"])

    return map_batches(texts.select("row", "text"), each, "row long, same binary, sample array<long>")


# ---- candidates and links --------------------------------------------------------------------------------
def buckets(signed: DataFrame) -> DataFrame:
    """(bucket, weight, node, sketch) of every bucket with more than one text: each band, and each band with the next. The
    sketch is a byte of each sample."""
    band = lambda b: [F.col("sample")[b % BANDS * ROWS + i] for i in range(ROWS)]
    entry = lambda weight, *key: F.struct(F.xxhash64(*key).alias("bucket"), F.lit(weight).alias("weight"))
    keys = [entry(1, F.lit(b), *band(b)) for b in range(BANDS)]
    keys += [entry(BANDS, F.lit(BANDS + b), *band(b), *band(b + 1)) for b in range(BANDS)]
    members = signed.where("sample IS NOT NULL").select(F.inline(F.array(*keys)), F.col("row").alias("node"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    sketch = F.transform("sample", lambda x: x.bitwiseAND(255).cast("short"))
    return members.join(shared, "bucket").join(signed.select(F.col("row").alias("node"), sketch.alias("sketch")), "node")


def spanning(members: DataFrame) -> DataFrame:
    """The members (bucket, weight, node, sketch, root) of buckets that still hold more than one class."""
    several = members.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return members.join(several.select("bucket"), "bucket", "left_semi")


def candidates(members: DataFrame, turn: int, every: bool) -> DataFrame:
    """(a, b, root_a, root_b): each member with the member of another class that its bucket picks by hash, if their sketches
    agree often enough. With ``every`` each bucket draws on its own, and all picks are returned. Without, buckets draw alike,
    so that families meet as stars, and only the pick is returned that most buckets of a member, weighed by their
    fineness, agree on."""
    draw = F.xxhash64("root", F.lit(turn), *(["bucket"] if every else []))
    pick = F.min(F.struct(draw.alias("draw"), F.xxhash64("node", F.lit(turn)).alias("next_draw"), "root", "node", "sketch")).alias("hub")
    agreeing = F.aggregate(F.zip_with("sketch", "hub.sketch", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    likely = members.join(members.groupBy("bucket").agg(pick), "bucket").where(F.col("root") != F.col("hub.root")).where(agreeing >= LEAST_AGREEING)
    pairs = likely.select(F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("hub.node").alias("b"), F.col("hub.root").alias("root_b"), "weight")
    counted = pairs.groupBy("a", "root_a", "b", "root_b").agg(F.sum("weight").alias("n"))
    if not every:
        best = F.max(F.struct("n", F.xxhash64("b", F.lit(turn)).alias("draw"), "b", "root_b")).alias("best")
        counted = counted.groupBy("a", "root_a").agg(best).select("a", "root_a", "best.b", "best.root_b")
    return counted.select("a", "b", "root_a", "root_b")


def verified(pairs: DataFrame, texts: DataFrame, idf, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose weighted Jaccard similarity is at least ``similarity``."""
    side = lambda k: texts.select(F.col("row").alias(k), F.col("text").alias(f"t_{k}"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = ("", None)
        keep = []
        for t_a, t_b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
            if known[1] is None or known[0] != t_b:
                known = (t_b, weighed(words(t_b), idf.value))
            keep.append(weighted_jaccard(weighed(words(t_a), idf.value), known[1]) >= similarity)
        return pa.record_batch(batch.columns[:4], names=pairs_columns).filter(pa.array(keep, pa.bool_()))

    pairs_columns = list(pairs.columns)
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select(*pairs.columns, "t_a", "t_b")
    return map_batches(joined, each, "a long, b long, root_a long, root_b long")


def long_sketches(texts: DataFrame, idf) -> DataFrame:
    """(node, sketch) of texts (node, text): a byte of each of LONG samples."""
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sketches = [samples(*weighed(words(t), idf.value), LONG).astype(np.uint8).tobytes() for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(sketches, pa.binary())], names=["node", "sketch"])

    return map_batches(texts.select("node", "text"), each, "node long, sketch binary")


def neighbours(rooted: DataFrame, turn: int) -> DataFrame:
    """(a, b, root_a, root_b) of texts (node, root, sketch) that lie close together in one of the orders of this turn and agree well."""
    orders = [np.random.Generator(np.random.PCG64([turn, i])).permutation(LONG) for i in range(ORDERS)]

    def permuted(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        sketch = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(n, LONG)
        keys = [k.tobytes() for order in orders for k in np.ascontiguousarray(sketch[:, order])]
        repeated = lambda i: pa.array(np.tile(batch.column(i).to_numpy(), ORDERS))
        return pa.record_batch([pa.array(np.repeat(np.arange(ORDERS, dtype=np.int32), n)), pa.array(keys, pa.binary()), repeated(0), repeated(1)],
                               names=["turn", "key", "node", "root"])

    def compared(batches):
        last = [np.zeros((0, LONG), np.uint8), *[np.zeros(0, np.int64)] * 3]
        for batch in batches:
            own = [np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, LONG)]
            rows = [np.concatenate([x, y]) for x, y in zip(last, own + [batch.column(i).to_numpy().astype(np.int64) for i in (0, 2, 3)], strict=True)]
            sketch, order, node, root = rows
            n, held = len(node), len(last[1])
            agree = np.zeros((n - held, REACH), np.uint8)
            for lag in range(1, min(REACH, n - 1) + 1):
                first = max(held, lag)
                same = (sketch[first:] == sketch[first - lag:n - lag]).sum(1, dtype=np.uint8)
                usable = (order[first:] == order[first - lag:n - lag]) & (root[first:] != root[first - lag:n - lag])
                agree[first - held:, lag - 1] = same * usable
            best = agree.argmax(1)
            at = np.flatnonzero(agree[np.arange(n - held), best] >= LONG_AGREEING)
            x, y = at + held, at + held - best[at] - 1
            swap = node[x] > node[y]
            a, b = np.where(swap, y, x), np.where(swap, x, y)
            yield pa.record_batch([node[a], node[b], root[a], root[b]], names=["a", "b", "root_a", "root_b"])
            last = [r[-REACH:] for r in rows]

    spread = map_batches(rooted.select("node", "root", "sketch"), permuted, "turn int, key binary, node long, root long")
    lined = spread.repartitionByRange("turn", "key", "node").sortWithinPartitions("turn", "key", "node")
    return stream_batches(lined, compared, "a long, b long, root_a long, root_b long").distinct()


class _Classes:
    """Classes joined in a task."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def join(self, x: int, y: int) -> None:
        self.parent[self.find(x)] = self.find(y)


def _links_between(rows: list[dict], idf: np.ndarray, similarity: float, same_block: bool, low: int) -> list[tuple[int, int, int, int]]:
    """Links among texts (node, root, at, buckets, sketch, text) of one block, or between those of block ``low`` and of another: of all pairs of
    different classes that share a bucket, without those whose classes are linked by then."""
    root = np.array([r["root"] for r in rows])
    if (root == root[0]).all():
        return []
    sketch = np.array([r["sketch"] for r in rows], np.int16)
    first = np.array([r["at"] == low for r in rows])
    index: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        for b in r["buckets"]:
            index.setdefault(b, []).append(i)
    held = {b: np.array(i) for b, i in index.items() if len(i) > 1}
    sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    classes, links = _Classes(), []

    def shingles(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in sets:
            sets[i] = weighed(words(rows[i]["text"]), idf)
        return sets[i]

    for i, r in enumerate(rows):
        if not (same_block or first[i]):
            continue
        meets = np.zeros(len(rows), bool)
        for b in r["buckets"]:
            if b in held:
                meets[held[b]] = True
        meets[:i + 1 if same_block else 0] = False
        if not same_block:
            meets &= ~first
        meets &= root != root[i]
        others = np.flatnonzero(meets)
        agree = (sketch[others] == sketch[i]).sum(1)
        for j in others[agree >= LEAST_AGREEING][np.argsort(-agree[agree >= LEAST_AGREEING], kind="stable")]:
            x, y = int(root[i]), int(root[j])
            if classes.find(x) != classes.find(y) and weighted_jaccard(shingles(i), shingles(j)) >= similarity:
                classes.join(x, y)
                links.append((r["node"], rows[j]["node"], x, y))
    return links


def links_left(members: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """(a, b, root_a, root_b): links by which all texts of shared buckets (of one band, which those of two lie within) that are similar come
    into one class."""
    coarse = members.where("weight = 1")
    hub = coarse.groupBy("bucket").agg(F.min("node").alias("hub"))
    groups = components(coarse.join(hub, "bucket").select(F.col("node").alias("a"), F.col("hub").alias("b")).where("a <> b").distinct())
    held = coarse.groupBy("node").agg(F.first("root").alias("root"), F.collect_set("bucket").alias("buckets"), F.first("sketch").alias("sketch"))
    placed = stable(held.join(groups.withColumnRenamed("root", "group"), "node").join(texts.select(F.col("row").alias("node"), "text"), "node"), "in-doubt")
    blocks = placed.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    at = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))
    copies = placed.join(blocks, "group").withColumn("at", at).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    keyed = copies.select("group", F.least("at", "other").alias("low"), F.greatest("at", "other").alias("high"), "at", "node", "root", "buckets", "sketch", "text")

    def each(batches):
        key, rows = None, []

        def compared() -> pa.RecordBatch:
            found = _links_between(rows, idf.value, similarity, key[1] == key[2], key[1])
            return pa.record_batch([pa.array([f[i] for f in found], pa.int64()) for i in range(4)], names=["a", "b", "root_a", "root_b"])

        for batch in batches:
            for row in batch.to_pylist():
                own = (row["group"], row["low"], row["high"])
                if own != key and rows:
                    yield compared()
                    rows = []
                key = own
                rows.append(row)
        if rows:
            yield compared()

    dealt = keyed.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high", "node")
    return stream_batches(dealt, each, "a long, b long, root_a long, root_b long")


def rarities(texts: DataFrame) -> np.ndarray:
    """The number of texts in each of ORDER_SLOTS hashed slots of shingles; that many numbers reach the driver."""
    def each(batches):
        counts = np.zeros(ORDER_SLOTS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts[np.unique(_order_slots(word_shingles(words(text), SHINGLE)[0]))] += 1
        found = np.flatnonzero(counts)
        for i in range(0, len(found), 1 << 16):
            slots = found[i:i + (1 << 16)]
            yield pa.record_batch([pa.array(slots), pa.array(counts[slots])], names=["slot", "n"])

    counted = stream_batches(texts.select("text"), each, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(ORDER_SLOTS, np.int64)
    df[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    return df


def _order_slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(40) & np.uint64(ORDER_SLOTS - 1)).astype(np.int64)


def prefixes(rooted: DataFrame, idf, rarity, similarity: float) -> DataFrame:
    """(shingle, node, root, before, total) of the rarest shingles of each text (node, root, text), as far as the first one that
    it shares with a similar text can lie; ``before`` is the weight of the rarer ones. Shingles of one text only are left out."""
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, lengths, before, totals = [], [], [], []
        for text in batch.column(2).to_pylist():
            shingles, weights = weighed(words(text), idf.value)
            df = rarity.value[_order_slots(shingles)]
            order = np.lexsort((shingles, df))
            ahead = np.cumsum(weights[order]) - weights[order]
            total = weights.sum()
            kept = (ahead <= (1 - similarity + _SLACK) * total) & (df[order] > 1)
            found.append(shingles[order][kept])
            before.append(ahead[kept])
            lengths.append(kept.sum())
            totals.append(total)
        lengths = np.array(lengths)
        repeated = lambda i: pa.array(np.repeat(batch.column(i).to_numpy(), lengths))
        return pa.record_batch([pa.array(np.concatenate(found).view(np.int64)), repeated(0), repeated(1), pa.array(np.concatenate(before)),
                                pa.array(np.repeat(np.array(totals, np.float64), lengths))], names=["shingle", "node", "root", "before", "total"])

    return map_batches(rooted.select("node", "root", "text"), each, "shingle long, node long, root long, before double, total double")


def all_candidates(members: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """(a, b, root_a, root_b): among the texts in buckets of several classes, all pairs of different classes that can be similar."""
    rarity = members.sparkSession.sparkContext.broadcast(rarities(texts))
    rooted = texts.withColumnRenamed("row", "node").join(members.select("node", "root").distinct(), "node")
    rare = stable(prefixes(rooted, idf, rarity, similarity), "prefixes")
    side = lambda k: rare.select("shingle", *[F.col(c).alias(f"{c}_{k}") for c in ("node", "root", "before", "total")])
    needed = (F.col("total_a") + F.col("total_b")) * (similarity / (1 + similarity) - _SLACK)
    met = side("a").join(side("b"), "shingle").where("node_a < node_b AND root_a <> root_b")
    met = met.where((F.col("total_a") - F.col("before_a") >= needed) & (F.col("total_b") - F.col("before_b") >= needed))
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "root_a", "root_b").distinct()


def relabelled(labels: DataFrame, moves: DataFrame) -> DataFrame:
    """Rows with their ``root`` replaced where it has moved."""
    moved = moves.select(F.col("node").alias("root"), F.col("root").alias("moved"))
    return labels.join(moved, "root", "left").withColumn("root", F.coalesce("moved", "root")).drop("moved")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, exact: bool = False) -> DataFrame:
    """One row per document: row, doc_id, class_id, class_size, first (whether it is the one that stands for its class).

    ``docs`` must be a table scan: its rows are numbered in several passes."""
    context = docs.sparkSession.sparkContext
    texts = numbered(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "row")
    idf = context.broadcast(document_shares(texts))
    signed = stable(signatures(texts, idf), "signatures")
    firsts = signed.groupBy("same").agg(F.min("row").alias("node"))
    distinct = signed.join(firsts.select(F.col("node").alias("row")), "row", "left_semi")
    members = stable(buckets(distinct).withColumn("root", F.col("node")), "buckets")
    shared = members.select(F.col("node").alias("row")).distinct()
    texts_shared = stable(texts.select("row", "text").join(shared, "row", "left_semi"), "texts")

    moves: list[DataFrame] = []

    def linked(pairs: DataFrame) -> int:
        """Verify pairs and contract the classes that they link; the number of links."""
        return contracted(stable(verified(pairs, texts_shared, idf, similarity), "links"))

    def contracted(links: DataFrame) -> int:
        nonlocal members
        if found := links.count():
            moves.append(components(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))))
            members = stable(spanning(relabelled(members, moves[-1])), "buckets")
        return found

    turn = 0
    while True:
        every = turn >= QUICK_ROUNDS
        pairs = stable(candidates(members, turn, every), "pairs")
        found = linked(pairs)
        turn += 1
        if every and found * PAYING <= pairs.count():
            break
    if not members.isEmpty():
        left = texts_shared.withColumnRenamed("row", "node").join(members.select("node").distinct(), "node", "left_semi")
        sketches = stable(long_sketches(left, idf), "sketches")
        linked(stable(neighbours(members.select("node", "root").distinct().join(sketches, "node"), turn), "pairs"))
    if not members.isEmpty():
        contracted(stable(links_left(members, texts_shared, idf, similarity), "links"))
    if exact and not members.isEmpty():
        linked(stable(all_candidates(members, texts_shared, idf, similarity), "pairs"))
    named = reduce(relabelled, moves, firsts.withColumn("root", F.col("node")))
    named = signed.select("row", "same").join(named, "same").join(texts.select("row", "doc_id"), "row")
    named = stable(named.select("row", "doc_id", "root"), "classes")
    summed = named.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("first_row"))
    return named.join(summed, "root").select("row", "doc_id", "class_id", "class_size", (F.col("row") == F.col("first_row")).alias("first"))


def keep_first(docs: DataFrame, similarity: float = SIMILARITY, exact: bool = False) -> DataFrame:
    """One document of each class, all columns: the smallest doc_id. ``docs`` must be a table scan."""
    return keep_rows(docs, near_classes(docs, similarity, exact).where("first"))

"""Repeated byte strings across documents, by refining buckets of suffixes.

Suffixes are first put into buckets of equal q-grams. Buckets with one member are done; the others are refined by the bucket
identifiers of later offsets, until a bucket stands for equal strings of ``LENGTH`` bytes. Identifiers are 64-bit hashes,
so suffixes of one bucket meet wherever their documents lie, and equal identifiers count as equal strings. Three fixed
refinements of anchors take the place of a recursion over all suffixes, which bounds LENGTH by 2 * Q:

1. Of every LENGTH-byte window only the smallest q-gram bucket inside is looked at (its anchor), so a run of windows
   shares one suffix. Which anchors are alone in the whole input? Those are done.
2. The others are refined by the identifiers at the ends of their whole run. A run that also occurs in a smaller document
   is covered. If all occurrences of an anchor have one and the same run, the smallest one is done, too.
3. What is left is refined window by window, by the identifiers at its first offset and LENGTH - Q later.

A window is covered if its bucket has a smaller doc_id; a byte is removed if a covered window holds it.

Texts are written once as packs of a few MB, in a table bucketed by pack. Each refinement is a pass over
the packs, a shuffle of packed identifiers by bucket, and small answers that join the packs where they lie, so texts
are never shuffled, and a pack gets its own answers only. A pack sends each identifier once, with its smallest document, so a
passage in a third of all documents is one number per pack; the number of identifier ranges grows with the input and the shuffle
partitions, which bounds the memory of a task. Packs times ranges are many messages, so they are cut and put together as whole
Arrow columns, with no Python object each.

Defined results: a NULL text is the empty text; texts are compared as UTF-8 bytes; a NULL doc_id is larger than any other;
rows with equal doc_id do not count as smaller than each other; texts of fewer than LENGTH bytes are kept whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm.common import stream_batches
from placemill.llm.shingles import grams, mix
from placemill.session import scratch_path, stable

LENGTH = 50
Q = 26
PACK_BYTES = 4 << 20
RANGE_BYTES = 64 << 20  # bytes of text whose identifiers one range holds at most about
RANGES_PER_PARTITION = 2
NO_ID = (1 << 63) - 1
BLOCK = 1 << 14  # windows looked at together, so that what is computed of them stays in the CPU's cache

_PACK = "pack long, ids array<long>, ends array<int>, data binary"
_SENT = "range int, pack long, keys binary, extra binary"
_ANSWER = "pack long, range int, answer binary"
_FOUND = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


# ---- Arrow columns ---------------------------------------------------------------------------------------
def _binary(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column: the stretches of the bytes between the cuts."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls in one array, and the cuts between its values."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, cuts, data = column.buffers()
    at = np.frombuffer(cuts, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def _list(column: pa.Array, i: int) -> pa.Array:
    """The values of a list column in a row."""
    cuts = column.offsets
    return column.values.slice(cuts[i].as_py(), cuts[i + 1].as_py() - cuts[i].as_py())


# ---- packs -----------------------------------------------------------------------------------------------
def _pack_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            if ids and held + len(data) > PACK_BYTES:
                yield _pack_row(pack, ids, texts)
                ids, texts, held, pack = [], [], 0, pack + 1
            ids.append(doc_id)
            texts.append(data)
            held += len(data)
    if ids:
        yield _pack_row(pack, ids, texts)


def _pack_row(pack: int, ids: list[int | None], texts: list[bytes]) -> pa.RecordBatch:
    ends = np.cumsum([len(t) for t in texts]).astype(np.int32)
    return pa.record_batch([
        pa.array([pack], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int32())),
        pa.array([b"".join(texts)], pa.binary()),
    ], names=["pack", "ids", "ends", "data"])


def packed(docs: DataFrame) -> DataFrame:
    """The texts as packs, in a table that is bucketed by pack."""
    spark = docs.sparkSession
    name = f"packs_{uuid.uuid4().hex}"
    rows = stream_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), _pack_stream, _PACK)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, "packs"))
     .bucketBy(buckets, "pack").saveAsTable(name))
    return spark.table(name)


# ---- suffixes of a pack ----------------------------------------------------------------------------------
def _anchored(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All q-gram identifiers; the windows at which the anchor changes or a document starts; their anchors' places."""
    span = LENGTH - Q + 1  # q-grams of a window
    windows = len(data) - LENGTH + 1
    ids, within = np.empty(len(data) - Q + 1, np.uint64), np.arange(BLOCK + span, dtype=np.uint64)
    begins, owners, before = [], [], -1
    for p in range(0, windows, BLOCK):
        w = min(BLOCK, windows - p)
        own = grams(data[p:p + w + LENGTH - 1], Q)
        ids[p:p + len(own)] = own
        least = (own & np.uint64(0xFFFFFFFF00000000)) | within[:len(own)]
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if span > width:
            least = np.minimum(least[:width - span], least[span - width:])
        owner = least.astype(np.uint32)  # the place: the lower half
        fresh = np.empty(w, bool)
        np.not_equal(owner[1:], owner[:-1], out=fresh[1:])
        fresh[0] = int(owner[0]) + p != before
        before = int(owner[-1]) + p
        a, b = np.searchsorted(starts, (p, p + w))
        fresh[starts[a:b] - p] = True
        here = np.flatnonzero(fresh)
        begins.append(here + p)
        owners.append(owner[here].astype(np.int64) + p)
    return ids, np.concatenate(begins), np.concatenate(owners)


class Runs:
    """Anchors of one pack: q-gram identifier, run identifier, first and last window, document."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, data: np.ndarray):
        self.data, self.ids, self.ends = data, ids, ends.astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        n = len(self.data)
        if n < LENGTH:
            self.grams = self.anchor = self.run = np.zeros(0, np.uint64)
            self.first = self.last = self.doc = np.zeros(0, np.int64)
            return
        self.grams, begins, at = _anchored(self.data, self.starts)
        doc = np.searchsorted(self.ends, begins, "right")
        limit = self.ends[doc] - LENGTH  # the document's last window
        last = np.minimum(np.append(begins[1:] - 1, n - LENGTH), limit)
        whole = begins <= limit
        begins, at = begins[whole], at[whole]
        self.first, self.last, self.doc = begins, last[whole], doc[whole]
        self.anchor = self.grams[at]
        shift, lengths = LENGTH - Q, self.last - begins + 1
        ends_of_run = self.grams[begins] * np.uint64(3) ^ mix(self.grams[begins + shift] + np.uint64(1)) ^ mix(self.grams[self.last + shift] + np.uint64(2))
        self.run = mix(ends_of_run + ((at - begins) << 8 | lengths).astype(np.uint64))

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First offsets of all windows of the chosen runs, and their documents' numbers."""
        lengths = (self.last - self.first + 1)[chosen]
        within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return np.repeat(self.first[chosen], lengths) + within, np.repeat(self.doc[chosen], lengths)

    def window_keys(self, at: np.ndarray) -> np.ndarray:
        return mix(self.grams[at] ^ mix(self.grams[at + LENGTH - Q] + np.uint64(3)))


def _split(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges (top bits) that sorted keys are in, and the cuts between their stretches."""
    tops = (keys >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(keys), np.int32)
    begins = np.flatnonzero(np.concatenate([[True], tops[1:] != tops[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return tops[begins], np.append(begins, len(keys))


def _least_doc(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the smallest document of each, and each row's place among them."""
    distinct, place = np.unique(keys, return_inverse=True)
    least = np.full(len(distinct), NO_ID, np.int64)
    np.minimum.at(least, place, docs)
    return distinct, least, place


# ---- what a pack asks, and what answers mean -------------------------------------------------------------
def _anchor_question(runs: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct anchors; of each a checksum of its run (0: several), and whether it repeats or has several runs."""
    anchors, place, count = np.unique(runs.anchor, return_inverse=True, return_counts=True)
    low, high = np.full(len(anchors), np.iinfo(np.uint64).max, np.uint64), np.zeros(len(anchors), np.uint64)
    np.minimum.at(low, place, runs.run)
    np.maximum.at(high, place, runs.run)
    several = low != high
    checksum = np.where(several, 0, (low >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)
    return anchors, place, checksum, count > 1, several


class Progress:
    """What the answers so far say about a pack's runs."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.pack = batch.column("pack")[i].as_py()
        self.doc_ids = _list(batch.column("ids"), i)
        self.runs = Runs(self.doc_ids.fill_null(NO_ID).to_numpy(), _list(batch.column("ends"), i).to_numpy(), _bytes(batch.column("data").slice(i, 1))[0])
        self.answers = _list(batch.column("answers"), i) if "answers" in batch.schema.names else None

    def _answer(self, turn: int) -> np.ndarray:
        """The answers of a turn, in the order of the keys: ranges are stretches of them."""
        if self.answers is None:
            return np.zeros(0, np.uint8)
        own = np.flatnonzero(self.answers.field("turn").to_numpy() == turn)
        own = own[np.argsort(self.answers.field("range").to_numpy()[own])]
        return _bytes(self.answers.field("answer").take(pa.array(own)))[0]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Per run: whether its anchor is shared, and whether it has several runs."""
        _, place, _, repeated, several = _anchor_question(self.runs)
        answer = self._answer(1)
        return ((answer & 1).astype(bool) | repeated)[place], ((answer & 2).astype(bool) | several)[place]

    def run_question(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        shared, several = self.anchors()
        chosen = np.flatnonzero(shared)
        runs = self.runs
        keys = mix(runs.anchor[chosen] ^ mix(runs.run[chosen]))
        return (*_least_doc(keys, runs.ids[runs.doc[chosen]]), chosen, several[chosen])

    def window_question(self) -> tuple:
        """Also the runs that are covered as a whole."""
        keys, least, place, chosen, several = self.run_question()
        docs = self.runs.ids[self.runs.doc[chosen]]
        covered = self._answer(2).astype(bool)[place] | (docs > least[place])
        at, doc = self.runs.windows(chosen[several & ~covered])
        return (*_least_doc(self.runs.window_keys(at), self.runs.ids[doc]), at, doc, chosen[covered])

    def covered_windows(self) -> np.ndarray:
        keys, least, place, at, doc, whole = self.window_question()
        single = at[self._answer(3).astype(bool)[place] | (self.runs.ids[doc] > least[place])]
        return np.concatenate([single, self.runs.windows(whole)[0]])


def _question(progress: Progress, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of a turn, and what goes with each."""
    if turn == 1:
        keys, _, checksum, _, _ = _anchor_question(progress.runs)
        return keys, checksum
    return (progress.run_question() if turn == 2 else progress.window_question())[:2]


def _sent(pack: int, keys: np.ndarray, extra: np.ndarray, bits: int, key_bytes: int) -> pa.RecordBatch:
    """One message per range: the keys' bytes below the range's bits, and what goes with them."""
    ranges, cuts = _split(keys, bits)
    raw = (keys << np.uint64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :key_bytes]
    return pa.record_batch([
        pa.array(ranges, pa.int32()), pa.array(np.full(len(ranges), pack), pa.int64()), _binary(raw, cuts * key_bytes),
        _binary(extra.view(np.uint8), cuts * extra.itemsize),
    ], names=["range", "pack", "keys", "extra"])


def _numbers(raw: np.ndarray, key_bytes: int) -> np.ndarray:
    wide = np.zeros((len(raw) // key_bytes, 8), np.uint8)
    wide[:, :key_bytes] = raw.reshape(-1, key_bytes)
    return wide.view(">u8").ravel().astype(np.uint64)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    return order, np.flatnonzero(first), np.cumsum(first) - 1


def answer_anchors(keys: np.ndarray, checksums: np.ndarray) -> np.ndarray:
    """1: another pack has the anchor, too; 2: it has several runs."""
    order, starts, group = _groups(keys)
    sums = checksums[order]
    low, high = np.minimum.reduceat(sums, starts), np.maximum.reduceat(sums, starts)
    several = (low != high) | (low == 0)
    shared = np.diff([*starts, len(keys)]) > 1
    out = np.empty(len(keys), np.uint8)
    out[order] = (shared.astype(np.uint8) + 2 * several.astype(np.uint8))[group]
    return out


def answer_least(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """1: another pack has the key in a smaller document."""
    order, starts, group = _groups(keys)
    ordered = docs[order]
    out = np.empty(len(keys), np.uint8)
    out[order] = ordered > np.minimum.reduceat(ordered, starts)[group]
    return out


# ---- passes ----------------------------------------------------------------------------------------------
def _messages(packs: DataFrame, turn: int, bits: int) -> DataFrame:
    key_bytes = 5 if turn == 1 else 8

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                progress = Progress(batch, i)
                keys, extra = _question(progress, turn)
                if len(keys):
                    yield _sent(progress.pack, keys, extra, bits, key_bytes)

    return stream_batches(packs, each, _SENT)


def _answered(messages: DataFrame, turn: int) -> DataFrame:
    """Answers to the messages of each range, which meet in one task."""
    key_bytes, kind, decide = (5, np.uint32, answer_anchors) if turn == 1 else (8, np.int64, answer_least)

    def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        raw, cuts = _bytes(rows.column("keys"))
        extra = np.ascontiguousarray(_bytes(rows.column("extra"))[0]).view(kind)
        out = decide(_numbers(raw, key_bytes), extra)
        return pa.record_batch([rows.column("pack"), rows.column("range"), _binary(out, cuts // key_bytes)], names=["pack", "range", "answer"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            ranges = batch.column("range").to_numpy()
            cuts = [0, *(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1).tolist(), len(ranges)] if len(ranges) else []
            for i, j in zip(cuts, cuts[1:], strict=False):
                if held and held[0].column("range")[0].as_py() != ranges[i]:
                    yield answer(held)
                    held = []
                held.append(batch.slice(i, j - i))
        if held:
            yield answer(held)

    return stream_batches(messages.repartition("range").sortWithinPartitions("range"), each, _ANSWER)


def _with_answers(packs: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Packs with their answers; the packs stay where their table's buckets lie."""
    rows = None
    for turn, a in enumerate(answers, 1):
        own = a.withColumn("turn", F.lit(turn))
        rows = own if rows is None else rows.unionByName(own)
    by_pack = rows.groupBy("pack").agg(F.collect_list(F.struct("turn", "range", "answer")).alias("answers"))
    return packs.join(by_pack.hint("shuffle_hash"), "pack", "left").withColumn(
        "answers", F.coalesce("answers", F.array().cast(by_pack.schema["answers"].dataType)))


def _removed(progress: Progress) -> pa.RecordBatch:
    """The documents of a pack with their removed runs and remaining bytes."""
    runs, covered = progress.runs, progress.covered_windows()
    n = len(runs.data)
    begun = np.zeros(n + 1, np.int32)  # covered windows that begin before a byte
    begun[covered + 1] = 1
    np.cumsum(begun, out=begun)
    gone = begun[1:] > begun[np.maximum(np.arange(1, n + 1) - LENGTH, 0)]
    # a run ends where a document does
    opens, closes = gone.copy(), gone.copy()
    inner = runs.starts[(runs.starts > 0) & (runs.starts < n)]
    cut = np.zeros(n + 1, bool)
    cut[inner] = True
    opens[1:] &= ~gone[:-1] | cut[1:n]
    closes[:-1] &= ~gone[1:] | cut[1:n]
    begins, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(runs.ends, begins, "right")
    offset = runs.starts[doc]
    spans = pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum(np.bincount(doc, minlength=len(runs.ids)))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(begins - offset, pa.int64()), pa.array(ends - offset, pa.int64())], ["start", "end"]))
    left = np.append(0, np.cumsum(~gone))[np.append(0, runs.ends)]
    return pa.record_batch([progress.doc_ids, pa.array(runs.ends - runs.starts, pa.int64()), spans, _binary(runs.data[~gone], left)],
                           names=["doc_id", "n_bytes", "spans", "kept"])


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans array<struct<start, end>> (the removed runs), kept (the remaining bytes) of every document."""
    packs = packed(docs)
    total = packs.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(int(total // RANGE_BYTES), RANGES_PER_PARTITION * partitions - 1).bit_length()
    answers: list[DataFrame] = []
    for turn in (1, 2, 3):
        known = _with_answers(packs, answers) if answers else packs
        answers.append(stable(_answered(_messages(known, turn, bits), turn), "answers"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _removed(Progress(batch, i))

    return stream_batches(_with_answers(packs, answers), finish, _FOUND)

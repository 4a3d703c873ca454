"""Cross-tokenizer alignment: where two tokenizers cut a text alike, and which of their tokens overlap how often.

Vocabulary A is byte-level BPE, read from its JSON file; B is a piece model. A encodes a space and the text, B the text, to which
it adds that space itself; special tokens in a text are plain text for both. Tokens become byte ends. The shorter list of ends
drives a galloping search into the longer one: from a guess in proportion, steps double until the value is passed, and
the last step is halved; all ends of a pack of texts do so in lockstep, as arrays. Ends found in both lists cut the tokens into
groups, and the ranks of two neighbouring ends bound the tokens that overlap the token between them.

Texts are processed in packs of about ``PACK_CHARS`` (one longer text is a pack of its own). A pack keeps, as one row of a table,
each text's distinct id pairs and how often it holds them, by number in a list of the pack's pairs. Counts over the corpus are sums
of packs' counts; they travel back as one row per pack and pair, so a pair that is in every text meets once per pack, and no text
is sent or encoded again.

A's ids come from a byte-pair encoder over the file's own ranks, which is used only if the file's merges are in the order of its
ids; otherwise, and where that encoder gives up, the file's own library encodes.

Defined results: NULL and empty texts, and texts whose tokens' joined bytes differ from the space and the text, have no tokens:
zeros, and an empty digest; repeated rows are counted as documents of their own; NULL doc_ids are kept; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill.llm.bpe import byte_letters
from placemill.llm.common import map_batches, stream_batches
from placemill.session import stable

PACK_CHARS = 2_000_000

# fixed value: how the byte-level vocabulary cuts a text into words
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE_SPACE = "▁"

_PACKED = ("pack long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digest array<string>, "
           "pairs array<long>, documents array<long>, held array<int>, at array<int>, times array<int>")
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# ---- galloping -------------------------------------------------------------------------------------------
def gallop(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each of the ascending ``short``, how many of the ascending ``long`` are less than it; searched from ``guess``."""
    n = len(long)
    at = np.clip(guess, 0, n - 1)
    low, high = at.copy(), at.copy()  # long[low] < value <= long[high] in the end; -1 and n lie outside
    behind = long[at] < short
    for side, sign in ((np.flatnonzero(behind), 1), (np.flatnonzero(~behind), -1)):
        far, near = (high, low) if sign > 0 else (low, high)
        step = 1
        while len(side):
            probe = np.clip(at[side] + sign * step, -1, n)
            less = (probe < 0) | (probe < n) & (long[np.clip(probe, 0, n - 1)] < short[side])
            passed = less == (sign < 0)
            far[side] = probe
            near[side[~passed]] = probe[~passed]
            side, step = side[~passed], step * 2
    wide = np.flatnonzero(high - low > 1)
    while len(wide):
        middle = (low[wide] + high[wide]) // 2
        less = long[middle] < short[wide]
        low[wide[less]] = middle[less]
        high[wide[~less]] = middle[~less]
        wide = wide[high[wide] - low[wide] > 1]
    return high


class Cuts:
    """Two tokenizations of the same texts: ``a`` and ``b`` hold byte lengths of tokens, ``n_a`` and ``n_b`` tokens per text."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.swapped = len(b) < len(a)
        short, long, n_short, n_long = (b, a, n_b, n_a) if self.swapped else (a, b, n_a, n_b)
        self.text = np.repeat(np.arange(len(n_short)), n_short)  # of each token of the shorter list
        short_ends, long_ends = np.cumsum(short), np.cumsum(long)
        first_short, first_long = np.cumsum(n_short) - n_short, np.cumsum(n_long) - n_long
        inside = np.arange(len(short)) - first_short[self.text]
        guess = first_long[self.text] + inside * n_long[self.text] // np.maximum(n_short, 1)[self.text]
        self.rank = gallop(short_ends, long_ends, guess) if len(short) else np.zeros(0, np.int64)
        self.common = np.flatnonzero(long_ends[self.rank] == short_ends) if len(short) else np.zeros(0, np.int64)
        alike = np.zeros(len(short), np.int64)
        alike[self.common] = 1
        # the tokens of the longer list from the one that holds the byte after the last end to the one that holds the byte before this one
        self.first = np.concatenate([[0], (self.rank + alike)[:-1]]) if len(short) else self.rank
        self.n_links = self.rank - self.first + 1
        ends = (self.common + 1, self.rank[self.common] + 1)
        self.a_ends, self.b_ends = ends[::-1] if self.swapped else ends  # tokens up to each group's end, over all texts
        self.groups = np.bincount(self.text[self.common], minlength=len(n_short))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, a, b) of all overlapping tokens, by position."""
        total = np.cumsum(self.n_links)
        short = np.repeat(np.arange(len(self.n_links)), self.n_links)
        long = np.arange(len(short)) - (total - self.n_links)[short] + self.first[short]
        a, b = (long, short) if self.swapped else (short, long)
        return self.text[short], a, b


# ---- the two vocabularies --------------------------------------------------------------------------------
class Vocabularies:
    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        import tiktoken

        self.a_json, data = a_json, json.loads(a_json)
        vocab = dict(data["model"]["vocab"]) | {t["content"]: t["id"] for t in data["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token)
        special = {t["id"] for t in data["added_tokens"]}
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        in_order = [vocab[x + y] for x, y in merges] == list(range(256, 256 + len(merges)))
        ranks = {self.a_bytes[i]: i for i in vocab.values() if i not in special}
        self.a = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}) if in_order else None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = range(self.b.get_piece_size())
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else
                        self.b.id_to_piece(i).replace(PIECE_SPACE, " ").encode() for i in pieces]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        told = [f"{i}{end}" for n, end in ((len(self.a_bytes), ","), (len(self.a_bytes), "|"), (len(pieces), ","), (len(pieces), ";")) for i in range(n)]
        self.told = np.array(told, object)
        self.own = None

    def encode_a(self, text: str) -> list[int]:
        if self.a is not None:
            try:
                return self.a.encode_ordinary(text)
            except BaseException as e:  # the encoder's own panics are no Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        if self.own is None:
            from tokenizers import Tokenizer

            self.own = Tokenizer.from_str(self.a_json)
            self.own.encode_special_tokens = True
        return self.own.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(a, b, n_a, n_b): ids of all texts, and how many each text has; none if their bytes are not the text's."""
        spelled_a, spelled_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        a, b = [], []
        for text in texts:
            own_a, own_b = [], []
            if text:
                whole = (" " + text).encode("utf-8", "surrogatepass")
                own_a, own_b = self.encode_a(" " + text), self.b.encode(text)
                if b"".join(map(spelled_a, own_a)) != whole or b"".join(map(spelled_b, own_b)) != whole:
                    own_a, own_b = [], []
            a.append(np.array(own_a, np.int64))
            b.append(np.array(own_b, np.int64))
        sizes = [np.array([len(x) for x in side], np.int64) for side in (a, b)]
        return np.concatenate(a), np.concatenate(b), *sizes

    def digests(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, cuts: Cuts) -> list[str]:
        """Of each text, the hash of its groups written as ids: A's, a bar, B's, a semicolon between groups."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cuts.a_ends - 1] = last_b[cuts.b_ends - 1] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        order = np.zeros(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], cuts.b_ends])[group_a]] = a + last_a * len(self.a_bytes)
        order[np.arange(len(b)) + cuts.a_ends[group_b]] = b + last_b * len(self.b_bytes) + 2 * len(self.a_bytes)
        ends = np.cumsum(n_a + n_b).tolist()
        words = self.told[order].tolist()
        return [hashlib.sha256("".join(words[i:j])[:-1].encode()).hexdigest() if j > i else "" for i, j in zip([0, *ends[:-1]], ends, strict=True)]


@lru_cache(1)
def _loaded(a_json: str, b_model: bytes) -> Vocabularies:
    return Vocabularies(a_json, b_model)


def _shared(df: DataFrame, a_path: str, b_path: str):
    """Both files' content, of fixed size; read on the driver only."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return df.sparkSession.sparkContext.broadcast((a.read(), b.read()))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _cut_up(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PACK_CHARS."""
    start = size = 0
    for i, text in enumerate(texts):
        more = len(text or "")
        if i > start and size + more > PACK_CHARS:
            yield start, i
            start, size = i, 0
        size += more
    if start < len(texts):
        yield start, len(texts)


# ---- over tables -----------------------------------------------------------------------------------------
def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, a_ids, b_ids, groups): the ids of both vocabularies, and per group how many of each end before its end."""
    shared = _shared(docs, a_path, b_path)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b, n_a, n_b = (v := _loaded(*shared.value)).encode(batch.column(1).to_pylist())
        cuts = Cuts(v.a_size[a], v.b_size[b], n_a, n_b)
        offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        text = np.repeat(np.arange(len(n_a)), cuts.groups)
        groups = pa.StructArray.from_arrays([pa.array(cuts.a_ends - (np.cumsum(n_a) - n_a)[text], pa.int32()),
                                             pa.array(cuts.b_ends - (np.cumsum(n_b) - n_b)[text], pa.int32())], names=["a_end", "b_end"])
        return pa.record_batch([
            batch.column(0), pa.ListArray.from_arrays(offsets(n_a), pa.array(a, pa.int32())),
            pa.ListArray.from_arrays(offsets(n_b), pa.array(b, pa.int32())), pa.ListArray.from_arrays(offsets(cuts.groups), groups)],
            names=["doc_id", "a_ids", "b_ids", "groups"])

    return map_batches(_texts(docs), each, "doc_id long, a_ids array<int>, b_ids array<int>, groups array<struct<a_end: int, b_end: int>>")


def packed(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per pack of texts: what is known of each text, and its pairs by number in the pack's list of pairs."""
    shared = _shared(docs, a_path, b_path)

    def row(number: int, doc_ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        v = _loaded(*shared.value)
        a, b, n_a, n_b = v.encode(texts)
        cuts = Cuts(v.a_size[a], v.b_size[b], n_a, n_b)
        text, at_a, at_b = cuts.links()
        span = len(v.a_bytes) * len(v.b_bytes)
        distinct, times = np.unique(text * span + a[at_a] * len(v.b_bytes) + b[at_b], return_counts=True)
        pairs, at, documents = np.unique(distinct % span, return_inverse=True, return_counts=True)
        lists = [(doc_ids, pa.int64()), (n_a, pa.int64()), (n_b, pa.int64()), (cuts.groups, pa.int64()),
                 (np.bincount(text, minlength=len(texts)), pa.int64()), (v.digests(a, b, n_a, n_b, cuts), pa.string()),
                 (pairs, pa.int64()), (documents, pa.int64()), (np.bincount(distinct // span, minlength=len(texts)), pa.int32()),
                 (at, pa.int32()), (times, pa.int32())]
        columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, kind)) for x, kind in lists]
        return pa.record_batch([pa.array([number], pa.int64()), *columns], names=[c.split()[0] for c in _PACKED.split(", ")])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _cut_up(texts):
                yield row(number, batch.column(0).slice(start, end - start), texts[start:end])
                number += 1

    return stream_batches(_texts(docs), each, _PACKED)


def pair_counts(packs: DataFrame, b_pieces: int) -> DataFrame:
    """(pair, n, best): in how many texts each pair is linked, and whether no pair of its A id is in more."""
    counts = packs.select(F.inline(F.arrays_zip("pairs", "documents"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("documents").alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {b_pieces}"))  # as many rows as B has pieces at most
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def agreement(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: token, group and link counts, and how common its links are in the whole table."""
    packs = stable(packed(docs, a_path, b_path), "packs")
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    held = packs.select(F.col("pack").alias("of_pack"), F.posexplode("pairs").alias("position", "pair"))
    known = held.join(pair_counts(packs, pieces), "pair").select("of_pack", "position", "n", "best")

    def each(pack: pa.Table, counts: pa.Table) -> pa.Table:
        if not pack.num_rows:
            return empty
        position = counts["position"].to_numpy()
        n, best = np.zeros(len(position), np.int64), np.zeros(len(position), np.int64)
        n[position], best[position] = counts["n"].to_numpy(), counts["best"].to_numpy(zero_copy_only=False)
        value = lambda c: pack[c].combine_chunks().flatten()
        at, times = value("at").to_numpy(), value("times").to_numpy().astype(np.int64)
        ends = np.cumsum(value("held").to_numpy())
        summed = lambda x: np.diff(np.concatenate([[0], np.cumsum(x * times)])[np.concatenate([[0], ends])])
        return pa.table([value("doc_id"), value("n_a"), value("n_b"), value("n_groups"), value("n_links"), pa.array(summed(best[at])),
                         pa.array(summed(n[at])), value("digest")], names=empty.schema.names)

    kinds = [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _RESULT.split(", ")]
    empty = pa.schema(kinds).empty_table()
    return packs.drop("pairs", "documents").groupBy("pack").cogroup(known.groupBy("of_pack")).applyInArrow(each, _RESULT)

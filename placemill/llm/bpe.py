"""BPE encoding and decoding with a word-level merge vocabulary, as the file's own library does it.

A short word holds its part boundaries and the ranks of adjacent parts in one contiguous array: the smallest rank is
found by a scan, its boundary is deleted, and the two neighbouring ranks are refreshed. Scanning is quadratic, so words
of more than ``SHORT`` symbols go through a heap of the same ranks with the same result. Each worker keeps words it has
met, the last ``CACHE_WORDS`` to twice as many.

The vocabulary's path is a parameter; its content travels to the tasks as one broadcast of fixed size.

Defined results: a NULL text is the empty text, which has no ids and decodes to the empty text; a NULL list of ids
decodes to the empty text; repeated rows are encoded alike; an empty table gives an empty result; further columns
are kept by ``encode`` and ``decode``.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm.common import map_batches, schema_text

SHORT = 100
CACHE_WORDS = 250_000
NO_RANK = 1 << 60

# fixed values of the vocabulary format: white space, the word pattern, the mark of a word's end
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE + r"\p{L}\p{N}]+"
WORD_END = "</w>"

# The same pattern spelled out for lower-case Latin-1 texts without apostrophes, which the standard library scans faster.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
COMMON_WORDS = rf"[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}\t-\r \x85\xa0]+"


@lru_cache(1)
def byte_letters() -> list[str]:
    """The printable letter of each byte: itself if visible in Latin-1, else the next free code point from 256."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    letters, free = [], 256
    for b in range(256):
        if b in visible:
            letters.append(chr(b))
        else:
            letters.append(chr(free))
            free += 1
    return letters


def _is_common(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "'" not in text


class WordBPE:
    """Encoder and decoder for one vocabulary file's content."""

    def __init__(self, content: str):
        data = json.loads(content)
        vocab: dict[str, int] = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        pairs = [p if isinstance(p, list) else p.split(" ") for p in data["model"]["merges"]]
        self.ranks = {(vocab[left], vocab[right]): rank for rank, (left, right) in enumerate(pairs)}
        self.merged = [vocab[left + right] for left, right in pairs]
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + WORD_END] for c in letters]
        self.words = regex.compile(WORDS)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.common_words = re.compile(COMMON_WORDS)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.shown = np.empty(max(self.tokens, default=0) + 1, object)
        for i, token in self.tokens.items():
            self.shown[i] = token

    def _merge_short(self, parts: list[int]) -> list[int]:
        rank_of, merged = self.ranks.get, self.merged
        ranks = [rank_of(pair, NO_RANK) for pair in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NO_RANK:
                break
            i = ranks.index(best)
            parts[i] = merged[best]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of((parts[i], parts[i + 1]), NO_RANK)
            if i:
                ranks[i - 1] = rank_of((parts[i - 1], parts[i]), NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        ranks, n = self.ranks, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and (p := (parts[left], parts[right])) in ranks:
                    heapq.heappush(heap, (ranks[p], left, p))
        return [p for p in parts if p >= 0]

    def _word(self, word: str) -> tuple[int, ...]:
        """A word not among the recent ones. The recent ones become the older ones when they are too many, so words in
        use are not forgotten."""
        ids = self.known.get(word) or self.older.get(word) or self._merged(word)
        if len(word) <= SHORT:
            if len(self.known) >= CACHE_WORDS:
                self.older, self.known = self.known, {}
            self.known[word] = ids
        return ids

    def _merged(self, word: str) -> tuple[int, ...]:
        data = word.encode("utf-8", "surrogatepass")
        parts = [self.inner[b] for b in data]
        parts[-1] = self.final[data[-1]]
        return tuple(self._merge_short(parts) if len(parts) <= SHORT else self._merge_long(parts))

    def _plain(self, text: str) -> list[int]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        words = (self.common_words if _is_common(text) else self.words).findall(text)
        found = list(map(self.known.get, words))
        if None in found:
            found = [self._word(w) if ids is None else ids for w, ids in zip(words, found, strict=True)]
        return list(chain.from_iterable(found))

    def encode(self, text: str) -> list[int]:
        if self.cut is None or "<|" not in text:
            return self._plain(text)
        ids = []
        for i, piece in enumerate(self.cut.split(text)):
            if i % 2:
                ids.append(self.special[piece])
            elif piece:
                ids.extend(self._plain(piece))
        return ids

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(2)
def _loaded(content: str) -> WordBPE:
    return WordBPE(content)


def _content(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:  # on the driver only
        return df.sparkSession.sparkContext.broadcast(f.read())


def _with(df: DataFrame, source: str, name: str, kind: str, fn) -> DataFrame:
    """Add a column computed over Arrow batches; an existing column of that name is replaced."""
    kept = df.drop(name)
    position = kept.columns.index(source)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([*batch.columns, fn(batch.column(position))], names=[*batch.schema.names, name])

    return map_batches(kept, each, f"{schema_text(kept)}, `{name}` {kind}")


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each text as an array."""
    content = _content(df, path)

    def lists(texts: pa.Array) -> pa.Array:
        bpe = _loaded(content.value)
        found = [bpe.encode(t) if t else [] for t in texts.to_pylist()]
        offsets = np.zeros(len(found) + 1, np.int32)
        np.cumsum([len(x) for x in found], out=offsets[1:])
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(offsets[-1]))
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return _with(df, text, ids, "array<int>", lists)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of each array of ids: its tokens joined by one space, special tokens included."""
    content = _content(df, path)

    def texts(lists: pa.Array) -> pa.Array:
        tokens = _loaded(content.value).shown[lists.flatten().to_numpy(zero_copy_only=False)]
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        return pa.array([" ".join(tokens[i:j].tolist()) for i, j in zip([0, *ends[:-1]], ends, strict=True)], pa.string())

    return _with(df, ids, text, "string", texts)


def encoded_digests(df: DataFrame, path: str) -> DataFrame:
    """Every column but the text and the ids, with n_tokens, ids_sha256 and decoded_sha256."""
    coded = decode(encode(df, path), path)
    return coded.withColumns({
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    }).drop("text", "ids", "decoded")

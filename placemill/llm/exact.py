"""Exact dedup with a cuckoo-filter index of live digests.

Texts are equal when they are identical after lower-casing A-Z. Each document is reduced to the SHA-256 and the byte
length of that text. Copies are folded twice with the same index: within each scan task, so that a digest held by
a third of all rows crosses the network once per task, and after a shuffle by digest. Rows arrive there sorted by
digest, so the index may be emptied between two digests and memory stays bounded whatever the partition's size.

The index is a cuckoo filter of 16-bit fingerprints whose cells also hold the stored key. A fingerprint hit is
verified against the key in its bucket; when a larger doc_id arrives, the live entry is deleted and the new one
inserted; when an insertion finds no room, the table doubles and is refilled from the stored keys.

Defined results: a NULL text is the empty text; of rows with equal text and doc_id one stays; a NULL doc_id is less
than any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm.common import keep_rows, map_batches, stream_batches
from placemill.session import stable

SLOTS = 4            # cells of a bucket
MAX_KICKS = 300      # displaced entries before the table doubles
LIVE_DIGESTS = 150_000  # entries a task holds before it hands them on

_GROUP = "digest binary, n_bytes long, keep_id long, keep_row long, group_size long"


class CuckooIndex:
    """A cuckoo filter with the stored keys beside the fingerprints. An entry is a list that starts with its digest
    and byte length; the rest belongs to the caller."""

    def __init__(self, buckets: int = 1 << 8):
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.fingerprints = array("H", bytes(2 * SLOTS * buckets))
        self.entries: list[list | None] = [None] * (SLOTS * buckets)
        self.live = 0

    def __len__(self) -> int:
        return self.live

    def __iter__(self) -> Iterator[list]:
        return (e for e in self.entries if e is not None)

    @staticmethod
    def _fingerprint(digest: bytes) -> int:
        return int.from_bytes(digest[8:10], "little") or 1

    def _home(self, digest: bytes) -> int:
        return int.from_bytes(digest[:8], "little") & (self.buckets - 1)

    def _other(self, bucket: int, fingerprint: int) -> int:
        return bucket ^ ((fingerprint * 0x5BD1E995 >> 7) & (self.buckets - 1))

    def _cell(self, digest: bytes, n_bytes: int) -> int:
        fingerprint = self._fingerprint(digest)
        home = self._home(digest)
        for bucket in (home, self._other(home, fingerprint)):
            for cell in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.fingerprints[cell] == fingerprint:
                    stored = self.entries[cell]
                    if stored[0] == digest and stored[1] == n_bytes:
                        return cell
        return -1

    def find(self, digest: bytes, n_bytes: int) -> list | None:
        cell = self._cell(digest, n_bytes)
        return None if cell < 0 else self.entries[cell]

    def delete(self, digest: bytes, n_bytes: int) -> list | None:
        """Remove and return the live entry."""
        cell = self._cell(digest, n_bytes)
        if cell < 0:
            return None
        entry, self.entries[cell], self.fingerprints[cell] = self.entries[cell], None, 0
        self.live -= 1
        return entry

    def _place(self, bucket: int, fingerprint: int, entry: list) -> bool:
        for cell in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.fingerprints[cell]:
                self.fingerprints[cell], self.entries[cell] = fingerprint, entry
                return True
        return False

    def insert(self, entry: list) -> None:
        self.live += 1
        fingerprint = self._fingerprint(entry[0])
        bucket = self._home(entry[0])
        if self._place(bucket, fingerprint, entry) or self._place(self._other(bucket, fingerprint), fingerprint, entry):
            return
        bucket = self._other(bucket, fingerprint)
        for kick in range(MAX_KICKS):
            cell = bucket * SLOTS + (kick + fingerprint) % SLOTS
            self.fingerprints[cell], fingerprint = fingerprint, self.fingerprints[cell]
            self.entries[cell], entry = entry, self.entries[cell]
            bucket = self._other(bucket, fingerprint)
            if self._place(bucket, fingerprint, entry):
                return
        stored = [*self, entry]
        self._clear(self.buckets * 2)
        for kept in stored:
            self.insert(kept)


def _digest_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    folded = [(t or "").encode("utf-8", "surrogatepass").lower() for t in batch.column(1).to_pylist()]
    return pa.record_batch([
        batch.column(0), batch.column(2), pa.array([hashlib.sha256(b).digest() for b in folded], pa.binary()),
        pa.array([len(b) for b in folded], pa.int64()),
    ], names=["doc_id", "row", "digest", "n_bytes"])


def text_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row, digest, n_bytes); ``row`` tells repeated rows of one input apart."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.monotonically_increasing_id().alias("row"))
    return map_batches(rows, _digest_batch, "doc_id long, row long, digest binary, n_bytes long")


def _order(doc_id: int | None, row: int) -> tuple:
    return (doc_id is not None, doc_id or 0, row)


def _emit(index: CuckooIndex) -> pa.RecordBatch:
    columns = list(zip(*index, strict=True))
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                           names=["digest", "n_bytes", "keep_id", "keep_row", "group_size"])


def fold_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest and stretch of input, with the largest document and the number of copies."""
    index, last = CuckooIndex(), None
    for batch in batches:
        for entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            digest, n_bytes, doc_id, row, copies = entry
            if len(index) >= LIVE_DIGESTS and digest != last:
                yield _emit(index)
                index = CuckooIndex()
            last = digest
            live = index.find(digest, n_bytes)
            if live is None:
                index.insert(list(entry))
            elif _order(doc_id, row) > _order(live[2], live[3]):
                index.delete(digest, n_bytes)
                index.insert([digest, n_bytes, doc_id, row, copies + live[4]])
            else:
                live[4] += copies
    if len(index):
        yield _emit(index)


def copy_groups(digests: DataFrame) -> DataFrame:
    """One row per text: (digest, n_bytes, keep_id, keep_row, group_size)."""
    rows = digests.select("digest", "n_bytes", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
                          F.lit(1).cast("long").alias("group_size"))
    combined = stream_batches(rows, fold_copies, _GROUP)
    by_digest = combined.repartition("digest").sortWithinPartitions("digest", "n_bytes")
    return stream_batches(by_digest, fold_copies, _GROUP)


def find_copies(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row, keep_id, group_size, kept, digest."""
    digests = stable(text_digests(docs), "digests")
    return digests.join(copy_groups(digests), ["digest", "n_bytes"]).select(
        "doc_id", "row", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, all columns. ``docs`` must be a table scan: its rows are numbered in two passes."""
    return keep_rows(docs, find_copies(docs).where("kept"))

import hashlib
import random
from collections import defaultdict

from placemill.llm.exact import CuckooIndex, drop_copies, find_copies
from tests.llm.helpers import awkward, stored, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_index_inserts_deletes_and_grows():
    index, rng = CuckooIndex(2), random.Random(1)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    for i, key in enumerate(keys):
        index.insert([key, 1, i])
    assert len(index) == 5000 and index.buckets > 1000
    gone = set(rng.sample(range(5000), 2000))
    for i in gone:
        assert index.delete(keys[i], 1)[2] == i
    assert index.delete(keys[min(gone)], 1) is None
    assert len(index) == 3000
    for i, key in enumerate(keys):
        assert (index.find(key, 1) is None) == (i in gone)
    assert index.find(keys[0], 2) is None  # same digest, other length


def test_hit_is_verified_by_the_stored_key():
    index = CuckooIndex(1)
    a, b = b"\0" * 8 + b"\1\1" + b"a" * 22, b"\0" * 8 + b"\1\1" + b"b" * 22  # one fingerprint, one bucket
    index.insert([a, 1])
    assert index.find(a, 1) and index.find(b, 1) is None


def test_groups_and_kept_rows(spark, tmp_path):
    rows = awkward()
    docs = stored(spark, rows, tmp_path)
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    got = find_copies(docs).collect()
    assert len(got) == len(rows)
    by_digest = defaultdict(list)
    for r in got:
        by_digest[bytes(r["digest"])].append(r)
    assert len(by_digest) == len(groups)
    for text, ids in groups.items():
        members = by_digest[hashlib.sha256(text.encode()).digest()]
        assert sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in members)
        keep = max((i for i in ids if i is not None), default=None)
        assert {(r["keep_id"], r["group_size"]) for r in members} == {(keep, len(ids))}
        assert [r["doc_id"] for r in members if r["kept"]] == [keep]
    left = drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)


def test_empty_table(spark):
    assert find_copies(table(spark, [])).count() == 0 and drop_copies(table(spark, [])).count() == 0

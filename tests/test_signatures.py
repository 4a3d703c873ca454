import random

from placemill.operators import signatures as s
from placemill.sources.registry import SourceSpec
from placemill_checks.frames import workbook

FILES = "file string, format string, encoding string, sheet string, content binary"


def test_titles_of_heads():
    assert s.titles_of("﻿a,b , c\n1,2,3\n".encode(), "csv") == ["a", "b", "c"]
    assert s.titles_of("Title\n名前,住所\n".encode("cp932") + b"x,y\n", "csv") == ["名前", "住所"]
    assert s.titles_of('"a\nb",c\n1,2\n'.encode(), "csv") == ["a\nb", "c"]
    assert s.titles_of(b"", "csv") == [] and s.titles_of(b"\n\n", "csv") == []
    assert s.titles_of(workbook([["Title row"], ["n", "p"], ["1", "2"]]), "excel") == ["n", "p"]
    for shift in range(4):  # a cut inside a character
        long = ("名前,住所" + "x" * shift + "\n" + "あ,いう\n" * 20_000).encode("cp932")
        assert s.titles_of(long[:s.HEAD_BYTES], "csv") == ["名前", "住所" + "x" * shift]


def test_near_signatures_equal_all_pairs(spark):
    rng = random.Random(6)
    sets = [sorted({"everywhere", *rng.sample("abcdefghij", rng.randint(1, 6))}) for _ in range(60)]
    files = [(f"f{i}", "csv", None, "#0", (",".join(t) + "\n1\n").encode()) for i, t in enumerate(sets)] + [("empty", "csv", None, None, b"")]
    signed = s.file_signatures(spark.createDataFrame(files, FILES))
    of = {r.file: (r.signature, set(r.titles)) for r in signed.collect()}
    assert of["empty"][1] == set() and all(of[f"f{i}"][1] == set(t) for i, t in enumerate(sets))
    for least in (0.5, 0.6, 0.75, 1.0):
        want = {(x, y, round(len(a & b) / len(a | b), 6)) for x, a in of.values() for y, b in of.values() if x < y and a and b and len(a & b) / len(a | b) >= least}
        assert {(r.signature, r.other, round(r.jaccard, 6)) for r in s.near_signatures(signed, least).collect()} == want
    clusters = s.signature_clusters(signed).collect()
    assert sum(r.n_files for r in clusters) == 61 and len(clusters) == len({x for x, _ in of.values()})


def test_proposals(spark):
    spec = lambda id, **m: SourceSpec(id, "P", "M", "own", id, "L", "csv", f"/{id}.csv", colmap=m, address_parts=("addr",))
    specs = [spec("one", name="n", phone="p"), spec("two", name="n", lat="y"), spec("three", name="zzz")]
    files = [("a", "csv", None, "#0", b"n,p,addr\n"), ("b", "csv", None, "#0", b"y,n\n"), ("c", "csv", None, "#0", b"nothing\n"), ("d", "csv", None, "#0", b"n,addr\n")]
    got = {r.file: (r.source_id, r.n_found, r.n_wanted) for r in s.propose_mappings(s.file_signatures(spark.createDataFrame(files, FILES)), specs).collect()}
    assert got == {"a": ("one", 3, 3), "b": ("two", 2, 3), "d": ("one", 2, 3)}

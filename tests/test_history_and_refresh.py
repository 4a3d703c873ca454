import random
from pathlib import Path

import pytest

from placemill import vocab
from placemill.operators.history import history_at, register_history
from placemill.operators.registers import merge_register
from placemill.sources.registry import SourceSpec
from placemill.streaming import buckets


def brute(states):
    deliveries = sorted({d for d, _, _ in states})
    seq = {d: i for i, d in enumerate(deliveries)}
    out = []
    for key in {k for _, k, _ in states}:
        own = sorted({seq[d]: b for d, k, b in states if k == key}.items())
        runs = []
        for i, (s, body) in enumerate(own):
            opened = "new" if i == 0 else "returned" if s - own[i - 1][0] > 1 else "changed" if body != own[i - 1][1] else None
            if opened:
                runs.append([s, s, 0, opened])
            runs[-1][1], runs[-1][2] = s, runs[-1][2] + 1
        out += [(key, n, deliveries[a], deliveries[b], count, opened, b == len(deliveries) - 1) for n, (a, b, count, opened) in enumerate(runs, 1)]
    return sorted(out)


def test_history_equals_brute_force(spark):
    rng = random.Random(3)
    states = [(f"2024-{m:02}", f"k{k}", f"b{rng.randint(0, 1)}") for m in range(1, 9) for k in range(60) if rng.random() < 0.6]
    frame = spark.createDataFrame(states + states[:50], "delivery string, match_key string, body string")
    history = register_history(frame)
    assert sorted(tuple(r) for r in history.collect()) == brute(states)
    assert {r.match_key for r in history_at(history, "2024-03").collect()} == {k for d, k, _ in states if d == "2024-03"}
    assert register_history(frame.where("false")).count() == 0


def rows_of(spark, delivery, **sources):
    out = []
    for rank, (srcid, names) in enumerate(sorted(sources.items())):
        for i, name in enumerate(names):
            values = {c: "" for c in vocab.REGISTER_COLUMNS} | {"name": name.split("=")[0], "phone": name, "sources": srcid, "licenses": "L"}
            out.append((*[values[c] for c in vocab.REGISTER_COLUMNS], srcid, rank, i, delivery))
    schema = ", ".join(f"{c} string" for c in vocab.REGISTER_COLUMNS) + ", srcid string, source_rank long, row_pos long, delivery string"
    return spark.createDataFrame(out, schema)


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet") if "bucket=" in str(f)}


def test_refresh_touches_only_what_differs(spark, tmp_path):
    path = str(tmp_path / "register")
    many = [f"shop {i}" for i in range(200)]
    state = {}

    def deliver(delivery, **sources):
        state.update(sources)
        before = files(path)
        touched = buckets.refresh(rows_of(spark, delivery, **sources), path, 32)
        after = files(path)
        kept = {f: t for f, t in before.items() if int(f.split("bucket=")[1].split("/")[0]) not in touched}
        assert kept.items() <= after.items()
        want = merge_register(rows_of(spark, "x", **state)).drop("first_seen")
        got = buckets.merged_buckets(spark, path).drop("first_seen")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        return touched

    assert len(deliver("2024-01", a=many, b=["shop 1", "other"])) == 32
    assert deliver("2024-02", a=many) == []                                    # the same again
    assert 1 <= len(deliver("2024-03", a=[*many[:-1], "new one"])) <= 2        # one closed, one opened
    assert 1 <= len(deliver("2024-04", b=["other=changed"])) <= 2              # b gives up a shop that a has, too
    assert len(deliver("2024-05", a=["alone"])) > 16                           # buckets that lose all their rows
    assert deliver("2024-06", b=[*["other=changed"]]) == []
    assert buckets.refresh(rows_of(spark, "2024-02", a=["too old"]), path, 32) == []


def test_take_in_from_files(spark, tmp_path):
    folder, path, progress = tmp_path / "in", str(tmp_path / "register"), str(tmp_path / "progress")
    specs = [SourceSpec(i, "P", "M", "own", f"Source {i}", "L", "csv", f"/registers/{i}.csv", colmap={"name": "n", "phone": "p"}) for i in "ab"]

    def deliver(month, **texts):
        (folder / month).mkdir(parents=True)
        for name, text in texts.items():
            (folder / month / f"{name}.csv").write_text(text)
        for _ in range(2):
            buckets.take_in(spark, str(folder), specs, path, progress, 8).awaitTermination()
        return {r.name: (r.phone, r.srcid, r.n_rows) for r in buckets.merged_buckets(spark, path).collect()}

    assert deliver("2024-01", a="n,p\nx,1\ny,2\n") == {"x": ("1", "a", 1), "y": ("2", "a", 1)}
    assert deliver("2024-02", a="n,p\nx,7\n", b="n,p\nx,9\nz,3\n") == {"x": ("7", "a,b", 2), "z": ("3", "b", 1)}
    assert deliver("2024-03", b="n,p\nz,4\nw,5\n") == {"x": ("7", "a", 1), "z": ("4", "b", 1), "w": ("5", "b", 1)}


@pytest.mark.parametrize("lost", ["rows", "nothing"])
def test_a_repeated_delivery_mends_a_failure(spark, tmp_path, lost):
    path = str(tmp_path / "register")
    buckets.refresh(rows_of(spark, "2024-01", a=["x", "y"]), path, 4)
    if lost == "rows":  # the merged buckets of the second delivery were written, its rows were not
        import shutil
        shutil.copytree(f"{path}/rows", tmp_path / "rows")
        shutil.copytree(f"{path}/sources", tmp_path / "sources")
    buckets.refresh(rows_of(spark, "2024-02", a=["x"]), path, 4)
    if lost == "rows":
        for part in ("rows", "sources"):
            shutil.rmtree(f"{path}/{part}")
            shutil.copytree(tmp_path / part, f"{path}/{part}")
    buckets.refresh(rows_of(spark, "2024-02", a=["x"]), path, 4)
    assert [r.name for r in buckets.merged_buckets(spark, path).collect()] == ["x"]

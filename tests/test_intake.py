import pytest

from placemill.sources.registry import SourceSpec
from placemill.streaming.intake import refresh_changes, snapshot, take_in


def spec(id, path):
    return SourceSpec(id, "P", "M", "own", f"Source {id}", "L", "csv", str(path), colmap={"name": "n", "phone": "p"})


@pytest.fixture
def intake(spark, tmp_path):
    folder, rows, progress = tmp_path / "in", str(tmp_path / "rows"), str(tmp_path / "progress")
    specs = [spec("a", "/registers/a.csv"), spec("b", "/registers/b_*.csv")]

    def deliver(month, **files):
        (folder / month).mkdir(parents=True)
        for name, text in files.items():
            (folder / month / f"{name}.csv").write_text(text)
        for _ in range(2):  # a rerun takes nothing in twice
            take_in(spark, str(folder), specs, rows, progress).awaitTermination()
        return {r.name: (r.phone, r.srcid, r.n_rows) for r in snapshot(spark, rows).collect()}

    deliver.rows = rows
    return deliver


def test_three_months(spark, intake):
    assert intake("2024-01", a="n,p\nx,1\ny,2\n") == {"x": ("1", "a", 1), "y": ("2", "a", 1)}
    # same file name again: y has closed, x has a new phone; another source under a dated name
    assert intake("2024-02", a="n,p\nx,7\n", b_202402="n,p\nx,9\nz,3\n") == {"x": ("7", "a,b", 2), "z": ("3", "b", 1)}
    # only b is delivered: a stays as it was
    assert intake("2024-03", b_202403="n,p\nz,4\nw,5\n") == {"x": ("7", "a", 1), "z": ("4", "b", 1), "w": ("5", "b", 1)}
    changes = {r["match_key"].strip("|"): r["change"] for r in refresh_changes(spark, intake.rows, "2024-01", "2024-03").collect()}
    assert sorted(changes.values()) == ["added", "added", "changed", "removed"]


def test_a_file_without_an_entry_is_an_error(intake):
    with pytest.raises(Exception, match="no register for"):
        intake("2024-01", unknown="n,p\nx,1\n")

"""The library without its optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from placemill_checks.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline_too", [False, True])
def test_imports_without_the_training_data_operators(tmp_path, pipeline_too):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "*.egg-info"))
    for folder in (copy / "placemill" / "llm", copy / "tests" / "llm"):
        if folder.exists():
            shutil.rmtree(folder)
    (copy / "placemill" / "llm" / "__pycache__").mkdir(parents=True)  # what an import once left
    if pipeline_too:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == list(QUERIES) and len(QUERIES) >= 48

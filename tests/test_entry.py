"""The entry with and without its parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from parity import QUERIES

REPO = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize(
    "without", [(), ("corpus_pipeline.py",), ("monthstar/llm",), ("monthstar/llm", "corpus_pipeline.py")]
)
def test_entry_imports_without(tmp_path, without):
    copy = tmp_path / "copy"
    left_out = {REPO / name for name in without}

    def ignore(folder, names):
        return [n for n in names if Path(folder, n) in left_out or n in (".git", "__pycache__", "tests")]

    shutil.copytree(REPO, copy, ignore=ignore)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    names, stated = (set(line.split()) for line in ran.stdout.splitlines()[-2:])
    assert set(QUERIES) <= names and stated <= names
    there = (copy / "monthstar/llm/__init__.py").exists()
    assert any(name.startswith("op1_") for name in names) == there
    assert ("pipeline" in names) == (there and (copy / "corpus_pipeline.py").exists())

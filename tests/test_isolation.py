"""The entry point and the rest of the library without the corpus subpackage."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).parent.parent


@pytest.mark.parametrize("gone", [["kinfold/llm", "tests/llm"], ["kinfold/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_point_without(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.parquet", ".pytest_cache"))
    for path in gone:
        at = copy / path
        if at.is_dir():
            shutil.rmtree(at)
        elif at.exists():
            at.unlink()
    code = "import __spark_entry__ as e; q = e.queries(); assert 'candidates_v1' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q); print(sum(k.startswith('op') for k in q))"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)}, timeout=120)
    assert said.returncode == 0, said.stderr
    assert (int(said.stdout) == 0) == ("kinfold/llm" in gone or not (ROOT / "kinfold" / "llm").exists())


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "kinfold").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(), path

"""The entry file without the folders of the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [["tillroll/llm", "tests/llm"], ["tillroll/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_imports_without_llm(tmp_path, gone):
    left_out = {ROOT / name for name in [*gone, ".git"]}
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [
        name for name in names if Path(folder) / name in left_out or name == "__pycache__"])
    code = ("import __spark_entry__ as e; names = set(e.queries()); "
            "assert 'receipts_valid' in names and 'pipeline' not in names and set(e.oracle_sql()) <= names")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr

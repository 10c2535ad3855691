"""The entry module with and without the operators for training data."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__  # noqa: F401
from checks.standins import QUERIES

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline_stays", [False, True])
@pytest.mark.parametrize("elsewhere", [None, ROOT])
def test_entry_does_without_the_training_data_operators(tmp_path, pipeline_stays, elsewhere):
    """Also with another copy on PYTHONPATH, which has them."""
    copy = tmp_path / "repo"
    left_out = ["llm", *([] if pipeline_stays else ["corpus_pipeline.py"])]
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(
        ".git", *left_out, "__pycache__", "*.json", ".pytest_cache"))
    found = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries(), *e.oracle_sql())"],
        cwd=copy, capture_output=True, text=True, check=True,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        | ({"PYTHONPATH": str(elsewhere)} if elsewhere else {}))
    assert set(found.stdout.split()) == set(QUERIES)

"""The library stands on its own: entry points without the subpackage for training data."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as e
names, sql = set(e.queries()), set(e.oracle_sql())
assert names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert sql and sql <= names, sql - names
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_subpackage(tmp_path, pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(
        f"{REPO}/rankwatch", copy / "rankwatch", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * pipeline:
        if os.path.exists(f"{REPO}/{name}"):
            shutil.copy(f"{REPO}/{name}", copy)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr

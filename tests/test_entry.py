"""The entry point with and without the optional modules."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]
BLOCK = """
import importlib.abc, sys
class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("shelfpulse.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Missing())
"""


def test_entry_without_the_folders(tmp_path):
    """A copy of the repository that lacks the optional package and its tests; the pipeline is there."""
    for name in ("queries", "shelfpulse"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path)
    text = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) ^ set(e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", text], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    count, left = done.stdout.split(maxsplit=1)
    assert int(count) >= 75 and left.strip() == "set()"


@pytest.mark.parametrize("head", ["", BLOCK])
def test_queries_and_sql_belong_together(head):
    text = head + "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) - set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", text], cwd=ROOT, capture_output=True, text=True, check=True)
    count, left = done.stdout.split(maxsplit=1)
    assert int(count) >= 75 and left.strip() == "set()"

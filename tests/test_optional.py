"""The library without its optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TRY = """
import __spark_entry__ as E
from tessera.plans.catalog import QUERIES
import tests.test_oracles
assert set(E.queries()) == set(E.oracle_sql()) == set(QUERIES), sorted(E.queries())
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_everything_else_works_without_the_subpackage(tmp_path, pipeline):
    copy = tmp_path / "copy"
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(os.path.join(ROOT, "tessera"), copy / "tessera", ignore=skip)
    shutil.copytree(os.path.join(ROOT, "tests"), copy / "tests", ignore=skip)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), copy)
    done = subprocess.run([sys.executable, "-c", TRY], cwd=copy, capture_output=True, text=True, timeout=120,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "tessera")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name)).read()
                assert "tessera.llm" not in text, name

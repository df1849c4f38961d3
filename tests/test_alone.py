"""The rest without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

ALONE = """
import __spark_entry__ as e
from textquarry.session import build_session
assert not [n for n in e.queries() if n.startswith("op") or n == "pipeline"], sorted(e.queries())
assert e.oracle_sql().keys() <= e.queries().keys() and len(e.queries()) > 90
spark = build_session("alone", "local[1]", **{"spark.ui.enabled": "false"})
assert e.entry(spark).count() > 0
"""


def run(folder, code):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, capture_output=True, text=True, timeout=240)


@pytest.fixture
def copy(tmp_path):
    at = tmp_path / "repo"
    shutil.copytree(ROOT, at, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    return at


def test_the_rest_runs_alone(copy):
    done = run(copy, ALONE)
    assert done.returncode == 0, done.stderr[-2000:]


def test_other_import_errors_are_errors(copy):
    (copy / "textquarry/llm").mkdir()
    (copy / "textquarry/llm/__init__.py").write_text("")
    (copy / "textquarry/llm/queries.py").write_text("import no_such_module")
    done = run(copy, "import __spark_entry__")
    assert done.returncode and "no_such_module" in done.stderr

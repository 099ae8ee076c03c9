"""The driver's entry file, with and without the optional folder."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

OPTIONAL = os.path.join("dossierflow", "llm")


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_optional_folder(tmp_path, pipeline):
    gone = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "repo", ignore=gone)
    code = "import __spark_entry__ as e; print(sorted(set(e.queries()) - set(e.QUERIES)), len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    names, count, covered = found.stdout.rsplit(None, 2)
    assert (names, covered) == ("[]", "True") and int(count) >= 51


@pytest.mark.skipif(not os.path.isdir(os.path.join(ROOT, OPTIONAL)), reason="the optional folder is absent")
def test_registers_optional_queries():
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and any(q.startswith("op13_") for q in entry.queries())

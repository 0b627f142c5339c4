"""The library without its optional parts, in a copy of its own."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"


def _names(folder) -> tuple[list[str], list[str]]:
    out = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, check=True)
    queries, statements = out.stdout.split("|")
    return queries.split(), statements.split()


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py")])
def test_medallion_queries_stay(tmp_path, gone):
    def skipped(_, names):
        return [n for n in names if n in gone or n in (".git", "__pycache__")]

    folder = shutil.copytree(ROOT, tmp_path / "copy", ignore=skipped)
    queries, statements = _names(folder)
    assert queries == statements and "pipeline_run" in queries and "pipeline" not in queries
    assert not any(name.startswith("op") for name in queries)


def test_other_missing_modules_are_errors(tmp_path):
    folder = shutil.copytree(
        ROOT, tmp_path / "copy", ignore=lambda _, names: [n for n in names if n in ("llm", ".git", "corpus_pipeline.py")]
    )
    (folder / "corpus_pipeline.py").write_text("import no_such_module\n")
    with pytest.raises(subprocess.CalledProcessError):
        _names(folder)

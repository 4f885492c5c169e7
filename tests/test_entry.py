from __future__ import annotations

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_the_optional_parts(tmp_path):
    """Without the subpackage and the pipeline the other queries are there."""
    import shutil

    shutil.copytree(REPO / "tessera", tmp_path / "tessera", ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); assert 'cellular_features' in q and 'pipeline' not in q, q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"})


def test_nothing_else_imports_the_subpackage():
    for p in (REPO / "tessera").rglob("*.py"):
        if "llm" not in p.relative_to(REPO).parts:
            assert "tessera.llm" not in p.read_text(), p

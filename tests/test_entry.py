"""The driver contract with and without the optional document subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def _names(folder):
    out = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=folder, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0, out.stderr
    return [set(line.split()) for line in out.stdout.splitlines()]


def test_entry_without_the_document_subpackage(tmp_dir):
    from spendloom.plans.catalog import ORACLE_SQL, QUERIES

    bare = os.path.join(tmp_dir, "repo")
    shutil.copytree(os.path.join(ROOT, "spendloom"), os.path.join(bare, "spendloom"), ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), bare)
    assert _names(bare) == [set(QUERIES), set(ORACLE_SQL)]
    assert set(QUERIES) == set(ORACLE_SQL)
    # nothing else in the library needs it
    for folder, _, files in os.walk(os.path.join(ROOT, "spendloom")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert "spendloom.llm" not in f.read()

"""The driver's entry with and without the subpackage that may be removed."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(','.join(e.queries())); print(','.join(e.oracle_sql()))"


def listed(folder):
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": os.fspath(folder)})
    return [line.split(",") for line in out.stdout.splitlines()]


def test_the_library_stands_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(os.path.join(ROOT, name), tmp_path)
    shutil.copytree(os.path.join(ROOT, "quirestone"), tmp_path / "quirestone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    queries, oracles = listed(tmp_path)
    assert len(queries) >= 59 and set(oracles) <= set(queries)
    assert not any(name.startswith("op") or name == "pipeline" for name in queries if name[2:3].isdigit() or name == "pipeline")
    os.remove(tmp_path / "corpus_pipeline.py")
    assert listed(tmp_path) == [queries, oracles]

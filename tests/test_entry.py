"""The library without its training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
import __spark_entry__ as E
q, o = E.queries(), E.oracle_sql()
assert not any(m.startswith("flyway.llm") for m in sys.modules), "llm imported"
assert not any(k.startswith("op") and k[2:3].isdigit() or k == "pipeline" for k in q), sorted(q)
assert set(o) <= set(q)
print(len(q))
"""


def _copy(tmp_path, *drop):
    keep = shutil.ignore_patterns("__pycache__", ".git", *drop)
    shutil.copytree(os.path.join(ROOT, "flyway"), tmp_path / "flyway", ignore=keep)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in drop and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path / name)


def _keys(folder):
    env = {**os.environ, "PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=folder, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    return int(done.stdout)


def test_without_llm_but_with_pipeline_file(tmp_path):
    _copy(tmp_path, "llm")
    assert _keys(tmp_path) >= 121


def test_without_llm_and_pipeline(tmp_path):
    _copy(tmp_path, "llm", "corpus_pipeline.py")
    assert _keys(tmp_path) >= 121

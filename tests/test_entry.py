"""The entry module with and without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry
from rowforge.plans.oracle import ORACLE_SQL
from rowforge.plans.queries import QUERIES
from rowforge.streaming.queries import STREAM_QUERIES

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(root):
    code = ("import __spark_entry__ as e; print('NAMES', *sorted(e.queries())); print('SQL', *sorted(e.oracle_sql()))")
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=root, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": root})
    assert done.returncode == 0, done.stderr[-2000:]
    lines = done.stdout.splitlines()
    return [next(x.split()[1:] for x in lines if x.startswith(k)) for k in ("NAMES", "SQL")]


def _copy(tmp_path, *left_out):
    root = str(tmp_path / "repo")
    skip = {os.path.join(HERE, x) for x in left_out}
    shutil.copytree(HERE, root, ignore=lambda d, names: [
        n for n in names if n in (".git", "__pycache__") or os.path.join(d, n) in skip])
    return root


def test_every_job_without_the_subpackage(tmp_path):
    """With or without the pipeline's file, which needs the subpackage."""
    base = sorted({**QUERIES, **STREAM_QUERIES})
    for k, left_out in enumerate([("rowforge/llm",), ("rowforge/llm", "corpus_pipeline.py")]):
        names, sql = _names(_copy(tmp_path / str(k), *left_out))
        assert names == base and sql == sorted(ORACLE_SQL)


def test_without_the_pipeline_only(tmp_path):
    if "pipeline" in entry.queries():
        names, _ = _names(_copy(tmp_path, "corpus_pipeline.py"))
        assert sorted(names) == sorted(set(entry.queries()) - {"pipeline"})


def test_another_missing_module_is_not_swallowed(tmp_path):
    if "pipeline" in entry.queries():
        root = _copy(tmp_path)
        with open(os.path.join(root, "corpus_pipeline.py"), "a") as f:
            f.write("\nimport rowforge.no_such_module\n")
        done = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; e.queries()"], cwd=root,
                              capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": root})
        assert done.returncode and "no_such_module" in done.stderr

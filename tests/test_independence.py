"""The rest works in a copy without the corpus operators, whether or not the pipeline's file is there."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_entry_without_corpus_operators(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if with_pipeline else ["corpus_pipeline.py"])))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 100 and set(o) <= set(q), (len(q), set(o) - set(q)); assert not any(k.startswith('op') or k == 'pipeline' for k in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr

"""The entry module without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as e
from tallybook import build_session
assert e.queries() and not [k for k in e.queries() if k.startswith("op") or k == "pipeline"]
assert set(e.oracle_sql()) == set(e.queries())
spark = build_session("local[2]", shuffle_partitions=2)
print("rows", e.queries()["pr_filter_flag"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_works_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "spark-warehouse"))
    assert (copy / "corpus_pipeline.py").exists() and not (copy / "tallybook" / "llm").exists()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(copy)}
    run = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0 and "rows " in run.stdout, run.stderr[-2000:]

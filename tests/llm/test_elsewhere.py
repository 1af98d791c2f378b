"""Queries with Python workers, started in another folder on workers that lack the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from statweave.session import build_session
import __spark_entry__ as contract
spark = build_session("local[4]", 4, "3g")
for name in {names!r}:
    assert contract.queries()[name](spark, {sf!r}).count() > 0, name
    print("done", name)
spark.stop()
"""
NAMES = ["op2", "op4", "op5", "op6", "op7", "op8", "op9", "op11", "op12", "op13", "pipeline"]


def test_workers_need_no_package(sf, tmp_path):
    import __spark_entry__ as contract

    names = [q for n in NAMES for q in contract.queries() if q == n or q.startswith(n + "_")]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=REPO, names=names, sf=sf)
    ran = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert ran.stdout.count("done") == len(names), ran.stderr[-3000:]

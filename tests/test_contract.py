"""Driver contract: bench.py prints one JSON line; __spark_entry__ exposes the three functions."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E
from tests.conftest import ROOT, SMOKE


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SMOKE, "BENCH_RUNS": "1", "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "scd2_history", "dup_bronze"],
                         env=env, capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and "errors" not in rec
    assert set(rec["queries"]) == {"scd2_history", "dup_bronze"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)


def test_entry_functions():
    assert callable(E.entry)
    q, s = E.queries(), E.oracle_sql()
    assert len(q) >= 40 and set(s) <= set(q)

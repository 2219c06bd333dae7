"""The driver contract: registry consistency and bench.py output."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_registry_is_consistent():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert all(fn.__doc__ for fn in qs.values())
    own = {k for k in qs if k != "pipeline" and not k.startswith("op")}
    assert len(own) >= 50 and own <= set(sqls)


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="flights_overview,error_counts")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], capture_output=True, text=True,
                         timeout=600, cwd=str(tmp_path), env=env)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and set(d["queries"]) == {"flights_overview", "error_counts"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01      # both are rounded to ms

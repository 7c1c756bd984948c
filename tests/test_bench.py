"""bench.py contract: one JSON line on stdout with metric, value, unit, queries and sf."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_out):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g",
               BENCH_OUT=tmp_out)
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["value"] > 0
    assert set(d["queries"]) == {"features", "quality", "forecast"}
    assert d["details"]["features"]["status"] == "done" and d["details"]["forecast"]["status"] == "done"

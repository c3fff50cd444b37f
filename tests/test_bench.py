"""bench.py runs and prints one JSON line of the agreed shape."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "tumbling_avg_speed"],
                         capture_output=True, text=True, env=env, timeout=600, check=True).stdout
    line = [x for x in out.splitlines() if x.startswith("{")][-1]
    d = json.loads(line)
    assert d["unit"] == "sec" and d["sf"] == "0.001" and set(d["queries"]) == {"tumbling_avg_speed"}
    assert d["value"] == round(sum(d["queries"].values()), 3)

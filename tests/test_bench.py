"""bench.py prints exactly one JSON line with the contract fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_KEYS="r05", BENCH_REPS="1",
               BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    rec = json.loads(out[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and set(rec["queries"]) == {"r05_segment_blackout"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01

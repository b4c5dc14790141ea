"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_QUERIES="sector_week_avg,vehicle_age_week_band")
    out = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert doc["unit"] == "sec" and doc["sf"] == 0.001 and set(doc["queries"]) == {"sector_week_avg", "vehicle_age_week_band"}
    assert doc["value"] == sum(doc["queries"].values()) or abs(doc["value"] - sum(doc["queries"].values())) < 0.01

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "default_by_year", "hash_split"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout
    lines = [l for l in out.splitlines() if l.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert set(d) == {"metric", "value", "unit", "queries", "sf"}
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"default_by_year", "hash_split"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01

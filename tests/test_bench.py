"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(sf_dir):
    env = dict(os.environ, BENCH_SF_DIR=sf_dir, BENCH_CPUS="2", BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "pit_ttl", "pull_latest"],
                         capture_output=True, text=True, env=env, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"pit_ttl", "pull_latest"}
    assert rec["value"] > 0 and rec["sf"] == os.path.basename(sf_dir).replace("sf", "")

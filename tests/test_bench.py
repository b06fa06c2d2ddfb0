"""bench.py prints one JSON line in the driver's format."""
import json
import os
import subprocess
import sys

from .conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_REPS="1", BENCH_CPUS="2",
               BENCH_KEYS="area_top3_product,page_convert_ratio", BENCH_STREAM="0")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd="/tmp",
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and isinstance(d["value"], float)
    assert set(d["queries"]) == {"area_top3_product", "page_convert_ratio"}

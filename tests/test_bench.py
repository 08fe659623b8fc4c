"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")
def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="silver_customers,fact_orders", BENCH_LANDING=str(tmp_path / "absent"),
               STRATA_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, cwd=str(tmp_path))
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"silver_customers", "fact_orders"}
    assert result["value"] == pytest.approx(sum(result["queries"].values()), abs=0.01)
    assert "failed" not in result and "landing_pipeline" not in result

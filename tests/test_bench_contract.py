"""bench.py prints exactly one JSON line with the fields the driver records."""
import json
import os
import subprocess
import sys

from .conftest import SF001

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_QUERIES="product_risk,null_counts",
               BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"product_risk", "null_counts"}
    assert result["value"] == round(sum(result["queries"].values()), 3)


def test_entry_contract_lists_match():
    import __spark_entry__ as entry
    from kestrel.plans.registry import ORACLES, QUERIES

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(QUERIES) >= 60
    assert set(QUERIES) <= set(queries) and set(ORACLES) <= set(oracles)
    assert set(QUERIES) - set(ORACLES) == {"pca_2d", "abstract_pca"}

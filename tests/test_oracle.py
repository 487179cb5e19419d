"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""
import pytest

import __spark_entry__ as entry
from kestrel.plans.compare import compare
from kestrel.plans.registry import QUERIES as ENGINE

from .conftest import SF01

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    res = compare(QUERIES[name](spark, SF01), ORACLES[name], SF01)
    assert res["columns_match"], res
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["values_match"], res


@pytest.mark.parametrize("name", sorted(set(ENGINE) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    # their values are held against numpy in test_semantics and test_properties
    assert QUERIES[name](spark, SF01).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["product_code", "risk_score", "risk_max", "flagged_ingredients", "total_ingredients"]
    assert df.count() > 0

"""Plan shape: the physical plans keep the properties the design relies on."""
import pytest
from pyspark.sql import functions as F

from kestrel.operators import dedupe, load
from kestrel.plans import all_queries
from kestrel.plans.registry import QUERIES

from .conftest import SF001

all_queries.load()
PYTHON_OPERATORS = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroups", "MapInPandas", "MapInArrow", "PythonUDF")
CROSS_OPERATORS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF001))
    # the one exception multiplies matrices on Arrow batches
    assert not [op for op in PYTHON_OPERATORS if op in plan] or name == "pca_covariance", plan
    assert not [op for op in CROSS_OPERATORS if op in plan], plan


def test_first_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"), F.col("id").alias("v"))
    plan = plan_of(dedupe.first_per_key(df, "k", ["seq"]))
    assert "partial_min_by" in plan and plan.index("partial_min_by") > plan.index("Exchange")


def test_top_n_is_salted_and_lag_is_bucketed(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id"))
    plan = plan_of(dedupe.first_n_per_group(df, "g", ["id"], 3))
    assert "WindowGroupLimit" in plan and "Partial" in plan.split("Exchange")[-1]   # pre-limited before the shuffle
    big = plan_of(dedupe.first_n_per_group(df, "g", ["id"], 5000))
    assert "_salt" in big.split("Window")[-1]                   # beyond the threshold: (group, salt) first
    keyed = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id"))
    lag = plan_of(dedupe.previous_in_key(keyed, "k", "id", "id", "p", "h"))
    window_specs = [line for line in lag.splitlines() if "windowspecdefinition" in line]
    assert window_specs and all("_b#" in line for line in window_specs if "lag(" in line)


def test_batch_load_narrows_the_target_first(spark):
    target = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    batch = spark.range(10).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("k"), F.lit(2).alias("v"))
    plan = plan_of(load.insert_if_absent(target, batch, "k", ["seq"]))
    assert "LeftSemi" in plan and "LeftAnti" in plan


def test_scans_are_pruned_and_weights_need_no_shuffle(spark):
    plan = plan_of(QUERIES["product_risk"](spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan             # only the key of orders is read
    # weights are computed inside the rows: no shuffle, the vocabulary is a constant
    tfidf = plan_of(QUERIES["tfidf_top_terms"](spark, SF001))
    assert "hashpartitioning" not in tfidf and "from_json" not in tfidf

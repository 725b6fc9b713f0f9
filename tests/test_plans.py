"""Plan checks: no cross products, and single-partition exchanges only above (partial) aggregates."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tabflow.plans import QUERIES as PLANS

HEAVY = {"stacked_model", "cv_lr", "fit_rf", "fit_gbt", "model_candidates", "kmeans_clusters", "pca_components",
         "batch_score", "hook_model", "fit_lr", "daily_usage_stream", "budget_admission_stream", "fit_leafwise",
         "fit_rf_interaction", "fit_gbt_interaction", "halving_search", "daily_usage_windowed"}
NAMES = sorted(n for n in PLANS if n not in HEAVY)


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            # a global aggregate's partial rows, or the small bucket-count table of ranking.running
            assert "Aggregate(" in below, (name, line, below)


def test_split_is_one_pass_over_the_table(spark):
    plan = E.queries()["stratified_split_keys"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Union" not in plan
    assert plan.count("FileScan parquet") == 2  # orders and customer
    check = E.queries()["split_partition_check"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert check.count("FileScan parquet") <= 4

"""Every registered query with an SQL twin equals DuckDB on the same tables (the driver's gate, locally)."""

import pytest

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL
from oracle import compare, duck

from tabflow.plans import QUERIES as PLANS

QUERIES = E.queries()
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in PLANS}


# what these say about a fitted model needs enough training rows to hold
LEARNT = {"fit_lr", "fit_rf", "fit_gbt", "fit_lr_balanced", "hook_model", "stacked_model", "cv_lr", "random_search_rf",
          "fit_rf_interaction", "fit_gbt_interaction", "halving_search", "fit_leafwise"}


@pytest.fixture(scope="module")
def cons():
    return {sf: duck(sf) for sf in (SF_SMALL, SF_MID)}


def test_every_query_is_registered_with_ops():
    from tabflow.plans import OPERATORS, QUERIES as OWN
    assert set(OPERATORS) == set(OWN) <= set(QUERIES)
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) >= 45


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, cons, name):
    sf = SF_MID if name in LEARNT else SF_SMALL
    r = compare(QUERIES[name](spark, sf), cons[sf], ORACLE[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["column", "position", "role"]

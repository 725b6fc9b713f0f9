"""A split table that is read many times is made once."""

import pytest

from conftest import SF_SMALL


@pytest.mark.parametrize("name", ["named_chain", "median_impute"])
def test_split_is_made_once_for_many_passes(spark, name):
    from tabflow.plans import QUERIES
    files = QUERIES[name](spark, SF_SMALL).inputFiles()
    assert any("/splits/" in f for f in files) and not any("orders.parquet" in f or "customer.parquet" in f for f in files)


def test_stored_split_of_an_empty_table(spark, tmp_path):
    from tabflow.plans.split_plans import labelled_split, stored_split
    for t in ("orders", "customer"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert stored_split(spark, str(tmp_path)).collect() == labelled_split(spark, str(tmp_path)).collect() == []

"""Rows of tree learners are dealt over all cores."""

import pytest
from pyspark.sql import functions as F

from tabflow.operators import models as MD


def _rows(spark, n=400):
    return spark.range(n).select(F.col("id").alias("key"), (F.col("id") % 7 / 7.0).alias("a"), (F.col("id") % 3).cast("int").alias("b"),
                                 F.when(F.col("id") % 7 > 3, 1).otherwise(0).alias("target"),
                                 F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"))


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_trees_train_on_all_cores(spark, monkeypatch, kind):
    seen, make = [], MD.classifier

    def spy(*args, **more):
        learner = make(*args, **more)
        fit = learner.fit
        learner.fit = lambda df: seen.append([len(p) for p in df.rdd.glom().collect()]) or fit(df)
        return learner

    monkeypatch.setattr(MD, "classifier", spy)
    one_file = _rows(spark).coalesce(1)
    small = {"rf": {"numTrees": 3, "maxDepth": 2}, "gbt": {"maxIter": 2, "maxDepth": 2}}[kind]
    model = MD.fit(one_file, {"numeric": ["a", "b"]}, kind, ["key"], params=small)
    cores = spark.sparkContext.defaultParallelism
    assert len(seen[0]) == cores and sum(seen[0]) == 320 and max(seen[0]) - min(seen[0]) <= cores
    assert MD.score(model, one_file, ["key"], kind).count() == 400


def test_more_rows_make_more_training_tasks(spark, monkeypatch):
    monkeypatch.setattr(MD, "ROWS_A_TASK", 10)
    cores = spark.sparkContext.defaultParallelism
    parts = MD.dealt(_rows(spark), ["key"]).rdd.glom().collect()
    assert len(parts) == cores * -(-400 // (cores * 10))
    assert sorted(r.key for p in parts for r in p) == list(range(400))
    assert all([r.key for r in p] == sorted(r.key for r in p) for p in parts)

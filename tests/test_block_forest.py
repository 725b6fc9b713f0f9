"""Forests of a stack grow on packed blocks of bins: the same kind of forest as Spark's, in Spark's model."""

import tempfile

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tabflow.operators import forest as FO
from tabflow.operators import models as MD


@pytest.fixture(scope="module")
def rows(spark):
    k = F.col("id")
    h = lambda s: F.pmod(F.xxhash64(k, F.lit(s)), F.lit(1000)) / 1000.0
    df = spark.range(3000).select(k.alias("key"), F.floor(h(1) * 40).cast("double").alias("a"), h(2).alias("b"), F.floor(h(3) * 5).cast("string").alias("c"), h(4).alias("u"))
    p = F.lit(0.15) + F.when(F.col("a") > 17, 0.4).otherwise(0.0) + F.when(F.col("c").isin("1", "4"), 0.3).otherwise(0.0) + F.when((F.col("b") > 0.6) & (F.col("a") < 9), 0.3).otherwise(0.0)
    df = df.withColumn("target", (F.col("u") < p).cast("int"))
    df = StringIndexer(inputCol="c", outputCol="ci", handleInvalid="keep", stringOrderType="alphabetAsc").fit(df).transform(df)
    return VectorAssembler(inputCols=["a", "b", "ci"], outputCol="features").transform(df).select("key", "target", "features").repartition(4).persist()


def _learner(**more):
    return RandomForestClassifier(**{"featuresCol": "features", "labelCol": "target", "seed": 7, **more})


def test_stack_grows_forests_on_blocks(spark, monkeypatch):
    seen, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    df = spark.range(900).select(F.col("id").alias("key"), (F.col("id") % 7 / 7.0).alias("a"), (F.col("id") % 11).cast("double").alias("b"),
                                 F.when((F.col("id") % 7 > 3) != (F.col("id") % 13 == 0), 1).otherwise(0).alias("target"), F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"))
    quick = {"lr": {"maxIter": 5}, "rf": {"numTrees": 5, "maxDepth": 3}}
    r = MD.stacked(df, {"numeric": ["a", "b"]}, ["lr", "rf"], ["key"], params=quick).first()
    assert r["valid"] and r["n_labels"] == 180 and r["auc"] > 0.8
    assert seen == [64]  # no training row goes through Spark's row-wise learner


def test_one_tree_is_sparks_tree(rows):
    for depth in (1, 3, 5):
        one = _learner(numTrees=1, maxDepth=depth, bootstrap=False, featureSubsetStrategy="all")
        ours, sparks = FO.fit_forest(one, rows), one.fit(rows)
        assert ours.toDebugString == sparks.toDebugString
        both = ours.transform(rows).select("key", "probability").join(sparks.transform(rows).select("key", F.col("probability").alias("q")), "key")
        assert both.where("probability <> q").count() == 0 and both.count() == 3000


def test_min_rows_and_gain_hold(rows):
    for more in ({"minInstancesPerNode": 250}, {"minInfoGain": 0.01}):
        one = _learner(numTrees=1, maxDepth=6, bootstrap=False, featureSubsetStrategy="all", **more)
        assert FO.fit_forest(one, rows).toDebugString == one.fit(rows).toDebugString


def test_forest_ranks_as_sparks_and_reloads(rows, monkeypatch):
    monkeypatch.setattr(FO, "BLOCK_ROWS", 200)  # several blocks a task
    auc = BinaryClassificationEvaluator(labelCol="target", numBins=0)
    many = _learner(numTrees=40, maxDepth=6)
    ours, again, sparks = FO.fit_forest(many, rows), FO.fit_forest(many, rows), many.fit(rows)
    assert isinstance(ours, RandomForestClassificationModel) and ours.getNumTrees == 40 and ours.numFeatures == 3 and ours.numClasses == 2
    assert ours.toDebugString == again.toDebugString
    assert len({t.toDebugString.split("\n", 1)[1] for t in ours.trees}) > 30  # trees differ: own samples, own features
    assert abs(auc.evaluate(ours.transform(rows)) - auc.evaluate(sparks.transform(rows))) < 0.02
    assert abs(sum(t.numNodes for t in ours.trees) / sum(t.numNodes for t in sparks.trees) - 1) < 0.2
    assert np.abs(ours.featureImportances.toArray() - sparks.featureImportances.toArray()).max() < 0.1
    path = tempfile.mkdtemp(prefix="tabflow-forest-") + "/m"
    ours.save(path)
    back = RandomForestClassificationModel.load(path)
    assert back.toDebugString == ours.toDebugString and back.getOrDefault("maxDepth") == 6


def test_bootstrap_counts_are_poisson_and_repeat():
    w = FO.draws(42, 3, 1 << 40, 200_001)
    assert len(w) == 200_001 and abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.005
    assert (w == FO.draws(42, 3, 1 << 40, 200_001)).all() and (w != FO.draws(42, 4, 1 << 40, 200_001)).any() and (w != FO.draws(-42, 3, 1 << 40, 200_001)).any()


def test_other_settings_and_labels_are_left_to_spark(rows):
    entropy = _learner(numTrees=3, maxDepth=3, impurity="entropy")
    assert FO.fit_forest(entropy, rows).toDebugString == entropy.fit(rows).toDebugString
    three = rows.withColumn("target", F.col("key") % 3)
    assert FO.fit_forest(_learner(numTrees=2, maxDepth=2), three).numClasses == 3


def test_edges_follow_sparks_rule():
    assert FO.edges_of(np.array([1.0, 2.0, 2.0, 5.0, np.nan]), 32).tolist() == [1.5, 3.5]
    assert FO.edges_of(np.array([3.0, 3.0]), 32).tolist() == []
    assert FO.edges_of(np.arange(100.0), 4).tolist() == [24.5, 49.5, 74.5]
    assert FO.bins_of(np.array([[1.5], [1.6], [np.nan]]), [np.array([1.5, 3.5])]).tolist() == [[0, 1, 2]]

"""Leaf-wise boosting: growth equals a plain best-first tree, patience, reload, missing values."""

import json

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_MID
from tabflow.operators import leafwise as LW
from tabflow.operators import models as MD
from tabflow.operators import profile as P
from tabflow.plans.split_plans import labelled_split


def table(spark, n=600, seed=0, parts=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(2)
    x[rng.random((n, 3)) < 0.05] = np.nan
    y = ((np.nan_to_num(x[:, 0]) > 0) != (np.nan_to_num(x[:, 1]) > 0.3)).astype(int)
    flip = rng.random(n) < 0.1
    y[flip] = 1 - y[flip]
    fold = rng.random(n) < 0.2
    rows = [(i, *map(float, r), int(t), bool(f)) for i, (r, t, f) in enumerate(zip(x, y, fold))]
    df = spark.createDataFrame(rows, "key long, a double, b double, c double, target int, fold boolean").repartition(parts)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep").transform(df)


def plain_tree(bins, y, base, leaves, min_rows, reg, n_bins):
    """Strictly best first, every histogram from the rows themselves; margins after one tree with step 1."""
    q = 1 / (1 + np.exp(-base))
    g, h = q - y, np.full(len(y), q * (1 - q))
    rows = {0: np.arange(len(y))}
    while len(rows) < leaves:
        found = []
        for leaf, r in rows.items():
            hist = np.zeros((bins.shape[1], n_bins, 3))
            for f in range(bins.shape[1]):
                for k, w in enumerate((g[r], h[r], np.ones(len(r)))):
                    hist[f, :, k] = np.bincount(bins[r, f], w, n_bins)
            found.append((*LW.best_split(hist, min_rows, reg), leaf))
        gain, f, b, leaf = max(found)
        if gain <= 1e-9:
            break
        r = rows.pop(leaf)
        left = bins[r, f] <= b
        new = max([leaf, *rows]) * 2 + 1
        rows[new], rows[new + 1] = r[left], r[~left]
    out = np.empty(len(y))
    for r in rows.values():
        out[r] = base - g[r].sum() / (h[r].sum() + reg)
    return out


@pytest.mark.parametrize("leaves", [2, 5, 12])
def test_one_tree_equals_a_plain_best_first_tree(spark, leaves):
    df = table(spark)
    m = LW.LeafwiseClassifier(maxIter=1, stepSize=1.0, numLeaves=leaves, minRows=10, leavesPerStep=1, maxBins=16).fit(df)
    state = json.loads(m.getOrDefault("model"))
    rows = df.select("key", vector_to_array("features").alias("x"), "target").collect()
    bins = LW.quantise(np.array([r.x for r in rows]), [np.array(e) for e in state["edges"]])
    y = np.array([r.target for r in rows])
    want = plain_tree(bins, y, state["base"], leaves, 10, 1.0, 17)
    got = {r.key: r.p for r in m.transform(df).select("key", vector_to_array("probability")[1].alias("p")).collect()}
    assert len(set(want)) <= leaves and [got[r.key] for r in rows] == pytest.approx((1 / (1 + np.exp(-want))).tolist(), abs=1e-9)


def test_patience_stops_and_the_best_round_is_kept(spark, tmp_path):
    df = table(spark, 900, 3).persist()
    est = LW.LeafwiseClassifier(maxIter=200, stepSize=0.8, numLeaves=6, patience=6, minRows=5, validationIndicatorCol="fold", rewriteEvery=3, leavesPerStep=5)
    m = est.fit(df)
    assert m.trees + 6 <= m.tried < 200
    assert est.fit(df).getOrDefault("model") == m.getOrDefault("model")  # a refit gives the same trees
    m.write().save(str(tmp_path / "m"))
    again = LW.LeafwiseModel.load(str(tmp_path / "m"))
    a, b = ({r.key: r.p for r in x.transform(df).select("key", vector_to_array("probability")[1].alias("p")).collect()} for x in (m, again))
    assert a == b and all(0 < p < 1 for p in a.values())


def test_no_split_and_one_class(spark):
    df = table(spark, 40)
    flat = LW.LeafwiseClassifier(maxIter=5, minRows=1000).fit(df)
    assert flat.trees == 0 and flat.transform(df).select(vector_to_array("probability")[1]).distinct().count() == 1
    one = LW.LeafwiseClassifier(maxIter=3).fit(df.withColumn("target", F.lit(1)))
    assert one.transform(df).select(F.min(vector_to_array("probability")[1])).first()[0] > 0.9


def test_auc_is_not_below_level_wise_boosting_at_equal_rounds(spark):
    sp = labelled_split(spark, SF_MID).persist()
    roles = P.roles(P.profile(sp.where("split = 'train'").drop("split")))
    rounds = {"maxIter": 8, "stepSize": 0.5}
    auc = {}
    for kind, more in (("gbt", {"maxDepth": 4, "validationTol": 0.0}), ("leafwise", {"numLeaves": 16, "patience": 15})):
        auc[kind] = MD.train_run(sp, roles, kind, ["key"], params={**rounds, **more})[1].first()["auc"]
    assert auc["leafwise"] >= auc["gbt"] - 0.005 and auc["leafwise"] > 0.85, auc

"""Fitted models are not SQL: own assertions (planted signal, reload equality, shapes)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tabflow.operators import models as MD
from tabflow.operators import profile as P
from tabflow.plans.split_plans import labelled_split

KEY = ["key"]


@pytest.fixture(scope="module")
def prepared(spark):
    sp = labelled_split(spark, SF_MID).persist()
    roles = P.roles(P.profile(sp.where(F.col("split") == "train").drop("split")))
    return sp, roles


def test_roles_of_labelled(prepared):
    _, roles = prepared
    assert roles["categorical"] == ["priority", "segment"]
    assert roles["high_cardinality"] == ["stock_code"]
    assert roles["id_like"] == ["customer_id"]


def test_lr_learns_planted_signal(prepared):
    sp, roles = prepared
    _, m = MD.train_run(sp, roles, "lr", KEY)
    r = m.first()
    assert r["valid"] and r["auc"] > 0.75, r
    assert r["n_val"] == 3000 and r["n_train"] == 12000


def test_tree_models_beat_baseline(prepared):
    sp, roles = prepared
    for kind in ("rf", "gbt"):
        _, m = MD.train_run(sp, roles, kind, KEY)
        assert m.first()["auc"] > 0.8, kind


def test_save_load_same_scores(spark, prepared):
    sp, roles = prepared
    model = MD.fit(sp, roles, "lr", KEY)
    path = tempfile.mkdtemp(prefix="tabflow-model-") + "/m"
    MD.save(model, path)
    val = sp.where(F.col("split") == "val")
    a = {r["key"]: r["p1"] for r in MD.score(model, val, KEY, "lr").collect()}
    b = {r["key"]: r["p1"] for r in MD.score(MD.load(path), val, KEY, "lr").collect()}
    assert a == b and len(a) == 3000


def test_clusters_and_components(prepared):
    sp, roles = prepared
    km = MD.cluster_features(sp, roles, KEY, 4)
    r = km.agg(F.min("cluster"), F.max("cluster"), F.min("distance"), F.count(F.lit(1))).first()
    assert r[0] >= 0 and r[1] <= 3 and r[2] >= 0 and r[3] == 15000
    pcs = MD.principal_components(sp, roles, KEY, 2)
    # components of standardised train data: mean ~0 on train
    m = pcs.where("split = 'train'").agg(F.avg("pc1"), F.avg("pc2")).first()
    assert abs(m[0]) < 1e-6 and abs(m[1]) < 1e-6


def test_composite_keys_in_stacking_and_search(spark):
    from tabflow.operators.split import stratified_split
    from tabflow.sources import fixtures as fx
    df = fx.labelled(spark, SF_MID).withColumn("part", F.col("key") % 5).withColumn("key", F.floor(F.col("key") / 5))
    key = ["key", "part"]  # neither column is unique
    sp = stratified_split(df.where("key < 400"), key).persist()
    roles = {"numeric": ["total_price", "acct_bal"]}
    quick = {"lr": {"maxIter": 5}, "rf": {"numTrees": 5, "maxDepth": 3, "seed": 1}}
    st = MD.stacked(sp, roles, ["lr", "rf"], key, folds=2, params=quick).first()
    cv = MD.search(sp, roles, key, "lr", {"regParam": [0.0, 0.1]}, folds=2, params=quick["lr"]).first()
    for r in (st, cv):
        assert r["valid"] and r["reason"] is None and r["auc"] > 0.7, r


def test_first_of_equal_candidates_is_the_best(spark):
    rows = spark.createDataFrame([("b", 0.8), ("a", 0.8), ("c", None), ("d", 0.7)], "model_id string, auc double")
    assert {r.model_id for r in MD.flag_best(rows, ["d", "a", "b", "c"]).where("is_best").collect()} == {"a"}
    assert MD.flag_best(rows.where("auc is null"), ["c"]).where("is_best").count() == 0

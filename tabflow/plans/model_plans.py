"""Registered model queries on the split ``labelled`` fixture.

A fitted model is not SQL, so each query returns what SQL can predict about it: row counts, the guard's
verdict, and measured facts that must hold (the model ranks the validation rows as well as the best single
column, within ``TOLERANCE`` of its AUC, which both engines compute; a reloaded model scores alike; every row's cluster is its
nearest centre; component variances are ordered).
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import profile as P
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import tables as TB
from .registry import register
from .split_plans import SPLIT_CTES, stored_split

KEY = ["key"]
SINGLE = ["total_price", "acct_bal", "nation_key"]
TOLERANCE, LOWEST = 0.02, -1e300


def _prepared(spark, sf_dir):
    # the split table feeds every stage fit, the model and scoring: written once, read by all of them
    sp = stored_split(spark, sf_dir)
    roles = P.roles(P.profile(sp.where(F.col("split") == "train").drop("split")))
    return sp, roles


def _best_single(sp):
    """The best AUC a single numeric column (nulls rank lowest) reaches on the validation rows, either direction."""
    val = sp.where(F.col("split") == "val")
    longf = val.select("target", F.inline(F.array(*[F.struct(
        F.lit(c).alias("model_id"), F.coalesce(F.col(c).cast("double"), F.lit(LOWEST)).alias("p1")) for c in SINGLE])))
    a = M.auc_by_group(longf)
    return a.agg(F.round(F.max(F.greatest("auc", 1 - F.col("auc"))), 9).alias("b")).first()["b"]  # one number


def _checked(ev, sp, *more):
    best = _best_single(sp)
    n = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}
    return ev.select("model_id", F.lit(n.get("train", 0)).cast("long").alias("n_train"), F.col("n_labels").alias("n_val"), "valid", "reason",
                     F.lit(best).alias("best_single_auc"), (F.col("auc") >= F.lit(best - TOLERANCE)).alias("keeps_up"), *more)


_SINGLE_SQL = ",\nsg AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS model_id, target, coalesce(CAST({c} AS DOUBLE), CAST({LOWEST} AS DOUBLE)) AS p1 "
    "FROM assigned WHERE split = 'val'" for c in SINGLE) + """),
sr AS (SELECT model_id, target, rank() OVER (PARTITION BY model_id ORDER BY p1) + (count(*) OVER (PARTITION BY model_id, p1) - 1) / 2.0 AS ar FROM sg),
ss AS (SELECT model_id, sum(CASE WHEN target = 1 THEN ar ELSE 0 END) AS rp, CAST(count_if(target = 1) AS DOUBLE) AS np,
              CAST(count_if(target = 0) AS DOUBLE) AS nn FROM sr GROUP BY model_id),
sb AS (SELECT round(max(greatest(a, 1 - a)), 9) AS best FROM (SELECT (rp - np * (np + 1) / 2) / (np * nn) AS a FROM ss) t)
"""


def _model_sql(ids: list[str], more: str = "") -> str:
    rows = " UNION ALL ".join(f"SELECT '{i}' AS model_id" for i in ids)
    return (fx.with_views("", "labelled").rstrip() + "," + SPLIT_CTES + _SINGLE_SQL
            + "SELECT model_id, (SELECT count(*) FROM assigned WHERE split = 'train') AS n_train, "
              "(SELECT count(*) FROM assigned WHERE split = 'val') AS n_val, TRUE AS valid, CAST(NULL AS VARCHAR) AS reason, "
              f"(SELECT best FROM sb) AS best_single_auc, TRUE AS keeps_up{more} FROM ({rows}) m")


def _assigned_sql(select: str) -> str:
    return fx.with_views("", "labelled").rstrip() + "," + SPLIT_CTES + select


def _run(kind):
    def q(spark, sf_dir):
        sp, roles = _prepared(spark, sf_dir)
        model = MD.fit(sp, roles, kind, KEY)
        val = sp.where(F.col("split") == "val")
        return _checked(M.evaluate(MD.score(model, val, KEY, kind), val.select("key", "target")), sp)
    return q


register("fit_lr", "M10 M18 M7 M2 M3 M4 P7", _model_sql(["lr"]))(_run("lr"))
register("fit_rf", "M11 M18", _model_sql(["rf"]))(_run("rf"))
register("fit_gbt", "M12 M18", _model_sql(["gbt"]))(_run("gbt"))


@register("model_candidates", "M19 A15", _model_sql(["lr", "rf"], ", TRUE AS one_best, TRUE AS best_is_max").replace(
    "n_train, (SELECT count(*) FROM assigned WHERE split = 'val') AS n_val, TRUE AS valid, CAST(NULL AS VARCHAR) AS reason, "
    "(SELECT best FROM sb) AS best_single_auc, TRUE AS keeps_up", "n_train, TRUE AS valid"))
def model_candidates(spark, sf_dir):
    sp, roles = _prepared(spark, sf_dir)
    c = MD.candidates(sp, roles, ["lr", "rf"], KEY)
    n_best = c.select(F.count_if("is_best")).scalar()
    top = c.select(F.max("auc")).scalar()
    return c.select("model_id", "n_train", "valid", (n_best == 1).alias("one_best"),
                    (F.col("is_best") == (F.col("auc") == top)).alias("best_is_max"))


@register("stacked_model", "M14", _model_sql(["stacked"]))
def stacked_model(spark, sf_dir):
    sp, roles = _prepared(spark, sf_dir)
    return _checked(MD.stacked(sp, roles, ["lr", "rf"], KEY), sp)


@register("cv_lr", "M15", _model_sql(["cv_lr"], ", 3 AS n_trials, TRUE AS in_grid"))
def cv_lr(spark, sf_dir):
    sp, roles = _prepared(spark, sf_dir)
    res = MD.search(sp, roles, KEY, "lr", {"regParam": [0.0, 0.01, 0.1]})
    found = F.get_json_object("best_params", "$.regParam").cast("double").isin(0.0, 0.01, 0.1)
    return _checked(res, sp, "n_trials", found.alias("in_grid"))


@register("random_search_rf", "M15", _model_sql(["cv_rf"], ", 2 AS n_trials, TRUE AS in_grid"))
def random_search_rf(spark, sf_dir):
    sp, roles = _prepared(spark, sf_dir)
    res = MD.search(sp, roles, KEY, "rf", {"numTrees": [10, 20], "maxDepth": [5, 8]}, folds=2, max_trials=2)
    found = F.get_json_object("best_params", "$.maxDepth").cast("int").isin(5, 8)
    return _checked(res, sp, "n_trials", found.alias("in_grid"))


@register("kmeans_clusters", "M16", _assigned_sql(
    "SELECT key, split, TRUE AS is_nearest, 4 AS n_distances, TRUE AS in_range FROM assigned"))
def kmeans_clusters(spark, sf_dir):
    sp, roles = _prepared(spark, sf_dir)
    c = MD.cluster_features(sp, roles, KEY, 4)
    return c.select("key", "split", (F.col("distance") <= F.array_min("distances") + 1e-9).alias("is_nearest"),
                    F.size("distances").alias("n_distances"), F.col("cluster").between(0, 3).alias("in_range"))


@register("pca_components", "M6 M5", _assigned_sql(
    "SELECT split, count(*) AS n_rows, TRUE AS variance_ordered, split = 'train' AS centred FROM assigned GROUP BY split"))
def pca_components(spark, sf_dir):
    sp, roles = _prepared(spark, sf_dir)
    pcs = MD.principal_components(sp, roles, KEY, 2)
    return pcs.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), (F.var_pop("pc1") >= F.var_pop("pc2")).alias("variance_ordered"),
        ((F.abs(F.avg("pc1")) < 1e-6) & (F.abs(F.avg("pc2")) < 1e-6)).alias("centred"))


@register("batch_score", "M17 S10 S8 P7", _assigned_sql(
    "SELECT key, 'lr' AS model_id, TRUE AS is_probability, TRUE AS same_after_reload FROM assigned"))
def batch_score(spark, sf_dir):
    """Every row of the table scored by a saved and reloaded model, through the prediction sink."""
    sp, roles = _prepared(spark, sf_dir)
    model = MD.fit(sp, roles, "lr", KEY)
    base = scratch_path(spark, f"models/{uuid.uuid4().hex}")
    MD.save(model, f"{base}/model")
    TB.write_predictions(MD.score(MD.load(f"{base}/model"), sp, KEY, "lr"), f"{base}/predictions")
    back = TB.read_predictions(spark, f"{base}/predictions")
    direct = MD.score(model, sp, KEY, "lr").select("key", F.col("p1").alias("direct"))
    return back.join(direct, "key").select("key", "model_id", F.col("p1").between(0, 1).alias("is_probability"),
                                           (F.abs(F.col("p1") - F.col("direct")) < 1e-12).alias("same_after_reload"))


@register("train_and_submit", "S1 S4 S8 S9 S10 J5 M17 M18 P7", _assigned_sql(
    "SELECT key AS id, TRUE AS has_target, split = 'val' AS was_val FROM assigned"))
def train_and_submit(spark, sf_dir):
    """CSV train, val and test files -> one dataset -> fit, save, load, score the test file -> submission CSV -> read back."""
    base = scratch_path(spark, f"submit/{uuid.uuid4().hex}")
    sp, _ = _prepared(spark, sf_dir)
    schema = sp.drop("split").schema
    for part in ("train", "val"):
        sp.where(F.col("split") == part).drop("split").write.option("header", True).csv(f"{base}/{part}")
    sp.drop("split").withColumn("target", F.lit(None).cast("int")).write.option("header", True).csv(f"{base}/test")
    ds = TB.load_dataset(spark, f"{base}/train", f"{base}/val", f"{base}/test", "csv", schema)
    roles = P.roles(P.profile(ds.where(F.col("split") == "train").drop("split")))
    model = MD.fit(ds, roles, "lr", KEY)
    MD.save(model, f"{base}/model")
    test = ds.where(F.col("split") == "test")
    TB.write_predictions(MD.score(MD.load(f"{base}/model"), test, KEY, "lr"), f"{base}/predictions")
    TB.write_submission(test, TB.read_predictions(spark, f"{base}/predictions"), "key", f"{base}/submission")
    out = spark.read.schema("id long, target double").option("header", True).csv(f"{base}/submission")
    val = ds.where(F.col("split") == "val").select(F.col("key").alias("id"), F.lit(True).alias("was_val"))
    return out.join(val, "id", "left").select("id", F.col("target").between(0, 1).alias("has_target"),
                                              F.coalesce("was_val", F.lit(False)).alias("was_val"))


def _log1p(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"total_price_log1p": np.log1p(pdf["total_price"].astype("float64"))})


@register("rowwise_features", "H2 H1", fx.with_views(
    "SELECT key, round(ln(1 + total_price), 9) AS total_price_log1p FROM labelled", "labelled"))
def rowwise_features(spark, sf_dir):
    df = fx.labelled(spark, sf_dir)
    out = FE.rowwise_hook(df, _log1p, ["total_price"], "total_price_log1p double", keep=["key"])
    return out.select("key", F.round("total_price_log1p", 9).alias("total_price_log1p"))



@register("hook_model", "H3 H4 M10", _model_sql(["hook_lr"]))
def hook_model(spark, sf_dir):
    from pyspark.ml.classification import LogisticRegression

    sp, roles = _prepared(spark, sf_dir)

    def build_model():  # a user hook: returns any Spark ML estimator
        return LogisticRegression(featuresCol="features", labelCol="target", regParam=0.01, elasticNetParam=0.5)

    model = MD.user_model(build_model, roles, KEY).fit(sp.where(F.col("split") == "train"))
    val = sp.where(F.col("split") == "val")
    return _checked(M.evaluate(MD.score(model, val, KEY, "hook_lr"), val.select("key", "target")), sp)


@register("fit_lr_balanced", "M10 A22 M18", _model_sql(["lr_balanced"]))
def fit_lr_balanced(spark, sf_dir):
    from pyspark.ml import Pipeline

    sp, roles = _prepared(spark, sf_dir)
    weights = E.class_weights(sp.where(F.col("split") == "train"))  # one row per class
    weighted = E.with_class_weights(sp, weights)
    stages, _ = MD.feature_stages(roles, exclude=("key", "target", "weight"))
    model = Pipeline(stages=stages + [MD.classifier("lr", weight_col="weight")]).fit(
        weighted.where(F.col("split") == "train"))
    val = weighted.where(F.col("split") == "val")
    return _checked(M.evaluate(MD.score(model, val, KEY, "lr_balanced"), val.select("key", "target")), sp)


# ---------------------------------------------------------------- a target that no single column ranks

_XOR = "(coalesce(total_price, 0) > 150000) <> (acct_bal > 4500)"
_XOR_FLIP = f"CASE WHEN ({_XOR}) <> (key % 12 = 0) THEN 1 ELSE 0 END"
XOR_GAIN = 0.15


def _xor_sql(ids: list[str], more: str = "") -> str:
    return _model_sql(ids, more).replace("labelled AS (", "plain AS (", 1).replace(
        ",\ncls AS (", f",\nlabelled AS (SELECT * EXCLUDE (target), {_XOR_FLIP} AS target FROM plain),\ncls AS (", 1).replace("keeps_up", "beats_single")


def _xor_prepared(spark, sf_dir):
    from ..operators.split import stratified_split
    df = fx.labelled(spark, sf_dir).withColumn("target", F.expr(_XOR_FLIP))
    path = scratch_path(spark, f"splits/{uuid.uuid4().hex}")
    TB.write_splits(stratified_split(df, "key", "target", 0.2, 42), path)
    sp = spark.read.parquet(path)
    return sp, P.roles(P.profile(sp.where(F.col("split") == "train").drop("split")))


def _xor_checked(ev, sp, *more):
    """The model has learnt what no column shows alone: its AUC is ``XOR_GAIN`` above the best single column's."""
    best = _best_single(sp)
    return _checked(ev, sp, (F.col("auc") >= F.lit(best + XOR_GAIN)).alias("beats_single"), *more).drop("keeps_up")


@register("fit_rf_interaction", "M11 M18", _xor_sql(["rf"]))
def fit_rf_interaction(spark, sf_dir):
    sp, roles = _xor_prepared(spark, sf_dir)
    val = sp.where(F.col("split") == "val")
    return _xor_checked(M.evaluate(MD.score(MD.fit(sp, roles, "rf", KEY), val, KEY, "rf"), val.select("key", "target")), sp)


@register("fit_gbt_interaction", "M12 M18", _xor_sql(["gbt"]))
def fit_gbt_interaction(spark, sf_dir):
    sp, roles = _xor_prepared(spark, sf_dir)
    val = sp.where(F.col("split") == "val")
    return _xor_checked(M.evaluate(MD.score(MD.fit(sp, roles, "gbt", KEY), val, KEY, "gbt"), val.select("key", "target")), sp)


# ---------------------------------------------------------------- successive halving over 15 trials

_TRIALS = [{"regParam": r, "elasticNetParam": e, "maxIter": 50} for r in (0.0, 0.001, 0.01, 0.1, 1.0) for e in (0.0, 0.5, 1.0)]
_PLACE = "CAST('0x' || substr(md5(concat('{}', ':', CAST(key AS VARCHAR))), 1, 5) AS BIGINT)"
_HALVING_SQL = _assigned_sql(
    "SELECT rung, CAST(n_trials AS BIGINT) AS n_trials, CAST(n_kept AS BIGINT) AS n_kept, (SELECT count(*) FROM assigned WHERE split = 'train' AND " + _PLACE.format(1043) + f" >= {int(0.2 * (1 << 20))} AND "
    + _PLACE.format(1042) + f" < {1 << 20} // divisor) AS n_train, (SELECT count(*) FROM assigned WHERE split = 'train' AND " + _PLACE.format(1043)
    + f" < {int(0.2 * (1 << 20))}) AS n_inner, TRUE AS best_kept, TRUE AS nested, TRUE AS winner_keeps_up "
      "FROM (VALUES (0, 15, 5, 9), (1, 5, 2, 3), (2, 2, 1, 1)) AS r(rung, n_trials, n_kept, divisor)")


@register("halving_search", "M15 A15", _HALVING_SQL)
def halving_search(spark, sf_dir):
    """Fifteen trials over three rungs: sizes of the rungs, the best of each goes on, the winner ranks val well."""
    from ..operators import halving as HV
    sp, roles = _prepared(spark, sf_dir)
    trials, res = HV.search(sp, roles, KEY, _TRIALS, "lr")
    best = _best_single(sp)
    won = res.select((F.col("valid") & (F.col("auc") >= F.lit(best - TOLERANCE))).alias("ok")).first()["ok"]
    top = trials.groupBy("rung").agg(F.count(F.lit(1)).alias("n_trials"), F.count_if("kept").alias("n_kept"), F.first("n_train").alias("n_train"),
                                     F.first("n_inner").alias("n_inner"), F.max("auc").alias("top"), F.max(F.when(F.col("kept"), F.col("auc"))).alias("top_kept"),
                                     F.collect_set("trial").alias("ran"), F.collect_set(F.when(F.col("kept"), F.col("trial"))).alias("went_on"))
    later = top.select((F.col("rung") - 1).alias("before"), F.col("ran").alias("next"))
    return top.join(later, F.col("rung") == F.col("before"), "left").select(
        "rung", "n_trials", "n_kept", "n_train", "n_inner", (F.col("top") == F.col("top_kept")).alias("best_kept"),
        F.coalesce(F.array_sort("next") == F.array_sort("went_on"), F.lit(True)).alias("nested"), F.lit(won).alias("winner_keeps_up"))


@register("fit_leafwise", "M12 M18", _xor_sql(["leafwise"], ", TRUE AS stopped_early"))
def fit_leafwise(spark, sf_dir):
    """Leaf-wise boosting stops by patience on an inner fold and learns the interaction (larger steps than the defaults)."""
    sp, roles = _xor_prepared(spark, sf_dir)
    model = MD.fit(sp, roles, "leafwise", KEY, params={"stepSize": 0.3, "numLeaves": 15, "patience": 10, "leavesPerStep": 7})
    val = sp.where(F.col("split") == "val")
    early = F.lit(model.stages[-1].tried < MD.DEFAULT_PARAMS["leafwise"]["maxIter"])
    return _xor_checked(M.evaluate(MD.score(model, val, KEY, "leafwise"), val.select("key", "target")), sp, early.alias("stopped_early"))

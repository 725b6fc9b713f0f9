"""Spark ML training, scoring and model search.

A model is a ``pyspark.ml`` Pipeline: the fitted feature chain (label codes,
frequency codes, median imputation, assembly) followed by a classifier. It is
fitted on the training split only and applied to any split; the positive-class
probability becomes ``p1`` (``vector_to_array(probability)[1]``) and is scored
with the guarded AUC of ``metrics.evaluate``.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import NAN_TOKEN, FrequencyEncoder, MedianImputer
from .forest import Stub, fit_forest
from .leafwise import LeafwiseClassifier
from .metrics import evaluate

SEED = 42


def feature_stages(roles: dict[str, list[str]], exclude: tuple[str, ...] = ()) -> tuple[list, list[str]]:
    """M7: the fitted feature chain for the profile roles; id-like columns are dropped.

    Numeric columns: exact train medians fill nulls (M2); categorical: alphabetical codes with a
    reserved code for unseen values (M3); high-cardinality: train frequencies (M4).
    """
    num = [c for c in roles.get("numeric", []) if c not in exclude]
    cat = [c for c in roles.get("categorical", []) if c not in exclude]
    hc = [c for c in roles.get("high_cardinality", []) if c not in exclude]
    sel = ["*"] + [f"CAST(`{c}` AS DOUBLE) AS `{c}__d`" for c in num] + \
          [f"coalesce(CAST(`{c}` AS STRING), '{NAN_TOKEN}') AS `{c}__s`" for c in cat]
    stages: list = [SQLTransformer(statement=f"SELECT {', '.join(sel)} FROM __THIS__")]
    feats: list[str] = []
    if num:
        stages.append(MedianImputer(inputCols=[f"{c}__d" for c in num], outputCols=[f"{c}__m" for c in num]))
        feats += [f"{c}__m" for c in num]
    if cat:
        stages.append(StringIndexer(inputCols=[f"{c}__s" for c in cat], outputCols=[f"{c}__i" for c in cat],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        feats += [f"{c}__i" for c in cat]
    if hc:
        stages.append(FrequencyEncoder(inputCols=hc, outputCols=[f"{c}__f" for c in hc]))
        feats += [f"{c}__f" for c in hc]
    stages.append(VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep"))
    return stages, feats


# The learners' settings unless a caller passes others (any Spark ML parameter of the estimator).
DEFAULT_PARAMS = {
    "lr": {"maxIter": 1000},
    # cached node ids: a row is not walked down from the root of every tree at every level; the forest is the same
    "rf": {"numTrees": 100, "maxDepth": 8, "seed": SEED, "cacheNodeIds": True},
    "gbt": {"maxIter": 500, "stepSize": 0.05, "maxDepth": 5, "validationTol": 0.001, "seed": SEED},
    "leafwise": {"maxIter": 500, "stepSize": 0.05, "numLeaves": 63, "patience": 50},
}
ESTIMATORS = {"lr": LogisticRegression, "rf": RandomForestClassifier, "gbt": GBTClassifier, "leafwise": LeafwiseClassifier}
BOOSTED = ("gbt", "leafwise")  # stop early on an inner fold of train
DEALT = ("rf", "gbt")  # every pass costs far more a row than reading it: their rows are dealt over all cores
ROWS_A_TASK = 500_000  # training rows of a task, at most, once all cores have one
ROWS_AT_ONCE = 4_000_000  # training rows of fits that run side by side; a larger fit has the cluster for itself


def classifier(kind: str, target: str = "target", weight_col: str | None = None, params: dict | None = None) -> Estimator:
    """The learners the reference's hooks reach for, as Spark ML estimators; ``params`` override the defaults."""
    if kind not in ESTIMATORS:
        raise ValueError(f"unknown classifier {kind}")
    settings = {"featuresCol": "features", "labelCol": target, **DEFAULT_PARAMS[kind], **(params or {})}
    if kind in BOOSTED:
        # early stopping on an inner fold of train (never on the scored split)
        settings.setdefault("validationIndicatorCol", "__es")
    if weight_col:
        settings["weightCol"] = weight_col
    return ESTIMATORS[kind](**settings)


def with_p1(scored: DataFrame, out: str = "p1") -> DataFrame:
    """Positive-class probability from the probability vector."""
    return scored.withColumn(out, vector_to_array("probability")[1])


def _early_stop_flag(df: DataFrame, key: list[str], share: int = 10) -> DataFrame:
    return df.withColumn("__es", F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(share)) == 0)


def dealt(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` in equal parts for all cores, ordered by key inside a part.

    The files of a table are cut by bytes, and a few of them hold millions of narrow rows: a learner that works for
    microseconds on a row would run on as many tasks as there are files.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    turns = max(1, math.ceil(rows.count() / (cores * ROWS_A_TASK)))
    return rows.repartition(cores * turns).sortWithinPartitions(*key)


def fit(split_df: DataFrame, roles: dict[str, list[str]], kind: str, key: list[str], target: str = "target",
        split_col: str = "split", params: dict | None = None) -> PipelineModel:
    train = split_df.where(F.col(split_col) == "train")
    if kind in BOOSTED:
        train = _early_stop_flag(train, key)
    stages, _ = feature_stages(roles, exclude=tuple(key) + (target,))
    learner = classifier(kind, target, params=params)
    if kind not in DEALT:
        return Pipeline(stages=stages + [learner]).fit(train)
    prep = Pipeline(stages=stages).fit(train)
    rows = prep.transform(train).select(*key, target, "features", *(["__es"] if kind in BOOSTED else []))
    return PipelineModel(prep.stages + [learner.fit(dealt(rows, key))])


def score(model: PipelineModel, df: DataFrame, key: list[str], model_id: str) -> DataFrame:
    """``(key..., model_id, p1)`` for every row of ``df``."""
    return with_p1(model.transform(df)).select(*key, F.lit(model_id).alias("model_id"), "p1")


def train_run(split_df: DataFrame, roles: dict[str, list[str]], kind: str, key: list[str], target: str = "target",
              split_col: str = "split", model_id: str | None = None, params: dict | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit on train, score val, guarded AUC; returns the model and a one-row metrics frame."""
    model_id = model_id or kind
    model = fit(split_df, roles, kind, key, target, split_col, params)
    val = split_df.where(F.col(split_col) == "val")
    preds = score(model, val, key, model_id)
    ev = evaluate(preds, val.select(*key, target), key=key, target=target)
    n_train = split_df.where(F.col(split_col) == "train").select(F.count(F.lit(1))).scalar()
    return model, ev.select("model_id", "auc", "valid", "reason", F.col("n_labels").alias("n_val")).withColumn(
        "n_train", n_train)


def candidates(split_df: DataFrame, roles: dict[str, list[str]], kinds: list[str], key: list[str],
               target: str = "target", parallelism: int = 2, params: dict[str, dict] | None = None) -> DataFrame:
    """Several candidate pipelines fitted concurrently on one persisted training set; best flagged.

    ``params`` holds the settings per kind. Of equal metrics the first in ``kinds`` is the best (A15).
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    split_df = split_df.persist(StorageLevel.MEMORY_AND_DISK)

    def run(kind):
        # one row per candidate, settled while the split is still held
        return train_run(split_df, roles, kind, key, target, params=(params or {}).get(kind))[1].checkpoint()

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        metrics = list(pool.map(inheritable_thread_target(run), kinds))
    split_df.unpersist()
    rows = metrics[0]
    for m in metrics[1:]:
        rows = rows.unionByName(m)
    return flag_best(rows, kinds)


def flag_best(rows: DataFrame, kinds: list[str]) -> DataFrame:
    """``is_best`` on the model with the highest metric; of equal ones the first in ``kinds``."""
    place = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("model_id"))
    best = rows.where(F.col("auc").isNotNull()).agg(F.max_by("model_id", F.struct("auc", -place)).alias("b"))
    return rows.withColumn("is_best", F.coalesce(F.col("model_id") == best.select("b").scalar(), F.lit(False)))


def featurized(split_df: DataFrame, roles: dict[str, list[str]], key: list[str], target: str = "target",
               folds: int | None = None, deal: bool = False) -> DataFrame:
    """Fit the feature chain once on train and assemble ``features`` for every row (persisted).

    The chain is target-free (codes, frequencies, medians), so fitting it once
    on all training rows leaks no label into out-of-fold scores; the learners
    that follow are refitted per fold. With ``deal`` the rows are ``dealt`` over all cores.
    """
    stages, _ = feature_stages(roles, exclude=tuple(key) + (target,))
    prep = Pipeline(stages=stages).fit(split_df.where(F.col("split") == "train"))
    out = prep.transform(split_df).select(*key, "split", target, "features")
    if folds:
        out = out.withColumn("__fold", F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(folds)))
    if deal:
        out = dealt(out, key)
    return out.persist(StorageLevel.MEMORY_AND_DISK)


def stacked(split_df: DataFrame, roles: dict[str, list[str]], bases: list[str], key: list[str],
            target: str = "target", folds: int = 3, parallelism: int = 4, params: dict[str, dict] | None = None) -> DataFrame:
    """Out-of-fold base scores on train (hash folds), a logistic meta-model, scored on val.

    The (base, fold) fits are independent Spark jobs and run from a small thread
    pool, as ``CrossValidator`` does with ``parallelism``. Forests grow on packed blocks (``forest``).
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    feats = featurized(split_df, roles, key, target, folds, deal=any(b in DEALT for b in bases))
    train = feats.where(F.col("split") == "train")
    val = feats.where(F.col("split") == "val")

    stub = Stub()

    def fit_one(job):
        b, f = job
        fit_part = train if f is None else train.where(F.col("__fold") != f)
        if b in BOOSTED:
            fit_part = _early_stop_flag(fit_part, key)
        learner = classifier(b, target, params=(params or {}).get(b))
        m = fit_forest(learner, fit_part, stub) if isinstance(learner, RandomForestClassifier) else learner.fit(fit_part)
        scored = val if f is None else train.where(F.col("__fold") == f)
        return b, f, with_p1(m.transform(scored)).select(*key, F.col("p1").alias(b))

    jobs = [(b, f) for b in bases for f in [*range(folds), None]]
    # a fit holds its rows (bootstrap counts, nodes) in memory: only as many run at once as fit there
    side_by_side = min(parallelism, ROWS_AT_ONCE // max(1, train.count()))
    with ThreadPoolExecutor(max_workers=max(1, side_by_side)) as pool:
        results = list(pool.map(inheritable_thread_target(fit_one), jobs))

    oof, val_scores = None, None
    for b in bases:
        parts = None
        for bb, f, p in results:
            if bb == b and f is not None:
                parts = p if parts is None else parts.unionByName(p)
        v = next(p for bb, f, p in results if bb == b and f is None)
        oof = parts if oof is None else oof.join(parts, key)
        val_scores = v if val_scores is None else val_scores.join(v, key)
    # read by every step of the meta-model: scored and joined once
    meta_train = oof.join(train.select(*key, target), key).persist(StorageLevel.MEMORY_AND_DISK)
    meta = Pipeline(stages=[VectorAssembler(inputCols=bases, outputCol="meta_x"),
                            LogisticRegression(featuresCol="meta_x", labelCol=target)]).fit(meta_train)
    meta_train.unpersist()
    preds = with_p1(meta.transform(val_scores)).select(*key, F.lit("stacked").alias("model_id"), "p1")
    res = evaluate(preds, val.select(*key, target), key=key, target=target)
    feats.unpersist()
    return res


def grid_points(grid: dict[str, list], max_trials: int | None = None, seed: int = SEED) -> list[dict]:
    """The grid's combinations; with ``max_trials`` a reproducible random choice of that many."""
    points = [dict(zip(grid, v)) for v in itertools.product(*grid.values())]
    if max_trials is None or max_trials >= len(points):
        return points
    return [points[i] for i in sorted(random.Random(seed).sample(range(len(points)), max_trials))]


def search(split_df: DataFrame, roles: dict[str, list[str]], key: list[str], kind: str = "lr", grid: dict[str, list] | None = None,
           target: str = "target", folds: int = 3, parallelism: int = 3, max_trials: int | None = None,
           params: dict | None = None) -> DataFrame:
    """Search over any learner's parameters with k-fold CV on train (exact AUC: ``numBins=0``); the best
    setting is refitted on train and scored on val. ``params`` are settings all trials share; ``best_params`` is JSON."""
    feats = featurized(split_df, roles, key, target, deal=kind in DEALT)
    if kind in BOOSTED:
        feats = _early_stop_flag(feats, key)
    est = classifier(kind, target, params=params)
    points = grid_points(grid or {"regParam": [0.0, 0.01, 0.1]}, max_trials)
    maps = [{est.getParam(k): v for k, v in p.items()} for p in points]
    ev = BinaryClassificationEvaluator(labelCol=target, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev, numFolds=folds, parallelism=parallelism, seed=SEED)
    model = cv.fit(feats.where(F.col("split") == "train"))
    best = max(range(len(points)), key=lambda i: (model.avgMetrics[i], -i))
    val = feats.where(F.col("split") == "val")
    preds = with_p1(model.bestModel.transform(val)).select(*key, F.lit(f"cv_{kind}").alias("model_id"), "p1")
    res = evaluate(preds, val.select(*key, target), key=key, target=target)
    feats.unpersist()
    return res.withColumn("best_params", F.lit(json.dumps(points[best], sort_keys=True))).withColumn("n_trials", F.lit(len(points)))


def scaled_features(split_df: DataFrame, roles: dict[str, list[str]], key: list[str], target: str = "target"):
    """Assembled features standardised with train mean and std (for KMeans / PCA)."""
    stages, _ = feature_stages(roles, exclude=tuple(key) + (target,))
    stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
    return Pipeline(stages=stages).fit(split_df.where(F.col("split") == "train"))


def cluster_features(split_df: DataFrame, roles: dict[str, list[str]], key: list[str], k: int = 4,
                     target: str = "target") -> DataFrame:
    """KMeans on train; every row gets its cluster, the distance to its centre and to all centres."""
    prep = scaled_features(split_df, roles, key, target)
    data = prep.transform(split_df)
    km = KMeans(featuresCol="scaled", predictionCol="cluster", k=k, seed=SEED).fit(data.where(F.col("split") == "train"))
    centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in km.clusterCenters()])
    out = km.transform(data).withColumn("__x", vector_to_array("scaled"))
    all_d = F.transform(centers, lambda c: F.sqrt(F.aggregate(
        F.zip_with("__x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)))
    out = out.withColumn("distances", all_d)
    return out.select(*key, "split", "cluster", F.element_at("distances", F.col("cluster") + 1).alias("distance"), "distances")


def principal_components(split_df: DataFrame, roles: dict[str, list[str]], key: list[str], k: int = 2,
                         target: str = "target") -> DataFrame:
    """M6: PCA fitted on standardised train features (components are defined up to sign)."""
    prep = scaled_features(split_df, roles, key, target)
    data = prep.transform(split_df)
    pca = PCA(k=k, inputCol="scaled", outputCol="pcs").fit(data.where(F.col("split") == "train"))
    arr = vector_to_array(F.col("pcs"))
    return pca.transform(data).select(*key, "split", *[arr[i].alias(f"pc{i + 1}") for i in range(k)])


def save(model: PipelineModel, path: str) -> None:
    """Persist the fitted chain and model."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def user_model(build_model: Callable[[], Estimator], roles: dict[str, list[str]], key: list[str],
               target: str = "target") -> Pipeline:
    """H3: a hook returning a Spark ML estimator, placed after the fitted feature chain."""
    stages, _ = feature_stages(roles, exclude=tuple(key) + (target,))
    return Pipeline(stages=stages + [build_model()])

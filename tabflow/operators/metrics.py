"""Guarded ROC-AUC keyed to held-out labels.

AUC is computed from score groups, never from a global sort:

    AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)

where ``s`` runs over distinct scores (ties count one half, as in the
Mann-Whitney statistic). Rows are first combined per (model, score) with a
map-side partial aggregate, so a score shared by a third of the rows is one
row; ``neg_below`` is a running sum from ``ranking.running`` (bucketed by
score, so even a single model never lands in one task).

Predictions are aligned with labels by key (an inner equi-join), not by
position. Guards make the metric null, with a reason, when predictions do not
cover the labels one to one, contain NaN/null or +/-Inf, or the labels hold a
single class.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import running

ROWS_A_TASK = 1 << 20  # predictions and labels that a task of the alignment sorts and groups, about


def _score_groups(joined: DataFrame, group: str, score: str, target: str) -> DataFrame:
    return joined.groupBy(group, score).agg(
        F.sum(F.col(target).cast("long")).alias("pos"),
        F.sum((1 - F.col(target)).cast("long")).alias("neg"))


def auc_from_groups(g: DataFrame, group: str = "model_id", score: str = "p1", n_buckets: int | None = None) -> DataFrame:
    """``(group, auc)`` from a table of (group, score, pos, neg) with distinct finite scores."""
    r = running(g, score, "neg", "sum", (group,), True, "neg_below", n_buckets)
    return r.groupBy(group).agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * F.lit(0.5))),
                     F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def auc_by_group(scored: DataFrame, group: str = "model_id", score: str = "p1", target: str = "target",
                 n_buckets: int | None = None) -> DataFrame:
    """``(group, auc)`` for rows that already carry a finite score and a 0/1 label."""
    return auc_from_groups(_score_groups(scored, group, score, target), group, score, n_buckets)


def _dealt_by_rows(left: DataFrame, lab: DataFrame, n_labels: int, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of the alignment dealt by key over tasks of about ``ROWS_A_TASK`` rows.

    Spark sizes tasks by compressed bytes, and 64 MB of these narrow rows are gigabytes once sorted and grouped.
    """
    tasks = math.ceil((n_labels + left.count()) / ROWS_A_TASK)
    if tasks <= 1:
        return left, lab
    tasks = max(tasks, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return left.repartition(tasks, *keys), lab.repartition(tasks, *keys)


def evaluate(preds: DataFrame, labels: DataFrame, key: str | list[str] = "key", target: str = "target",
             group: str = "model_id", score: str = "p1", n_buckets: int | None = None) -> DataFrame:
    """Per model: counts, guard verdict and AUC (null unless valid).

    The big join (predictions x labels) runs once: it is reduced to score
    groups (one row per model and distinct finite score, plus one for the
    non-finite rows) and that small table is checkpointed for the AUC steps.
    """
    keys = [key] if isinstance(key, str) else list(key)
    p = F.col("p")
    bad = p.isNull() | F.isnan(p) | (F.abs(p) == F.lit(float("inf")))
    lab = labels.select(*keys, F.col(target).cast("int").alias(target), F.lit(1).alias("__known"))  # 0/1, boolean accepted
    n_labels, left = lab.count(), preds.select(group, *keys, F.col(score).alias("p"))
    left, lab = _dealt_by_rows(left, lab, n_labels, keys)
    # one pass: the left join keeps unmatched predictions; rows of a (key, model) are already together for the count
    joined = left.join(lab, keys, "left")
    per_key = joined.groupBy(*keys, group).agg(
        F.count(F.lit(1)).alias("rows"), F.min("p").alias("p"), F.max(target).alias(target), F.max("__known").alias("known"),
        F.count_if(p.isNull() | F.isnan(p)).alias("nan"), F.count_if(F.abs(p) == F.lit(float("inf"))).alias("inf"))
    # null keys match no label and are no duplicates of each other
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    hit = F.col("known").isNotNull()
    groups = (per_key.withColumn(score, F.when(bad | ~hit, F.lit(None).cast("double")).otherwise(p))
              .groupBy(group, score).agg(
                  F.sum(F.when(hit, F.col(target)).cast("long")).alias("pos"),
                  F.sum(F.when(hit, 1 - F.col(target)).cast("long")).alias("neg"),
                  F.sum("rows").alias("rows"), F.count_if(hit).alias("keys"),
                  F.count_if((F.col("rows") > 1) & ~null_key).alias("dup"), F.sum("nan").alias("nan"), F.sum("inf").alias("inf"))
              .checkpoint())
    stats = groups.groupBy(group).agg(
        F.sum("rows").alias("n_preds"), F.sum("nan").alias("n_nan"), F.sum("inf").alias("n_inf"),
        F.sum("keys").alias("n_matched"), F.sum("dup").alias("n_duplicate"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"))
    aucs = auc_from_groups(groups.where(F.col(score).isNotNull()), group, score, n_buckets)

    # the two per-model tables are stacked and merged by one group-by (no join:
    # a constant model id would otherwise turn it into a nested loop)
    merged = stats.unionByName(aucs, allowMissingColumns=True).groupBy(group).agg(*[F.max(c).alias(c) for c in (
        "n_preds", "n_nan", "n_inf", "n_matched", "n_duplicate", "n_pos", "n_neg", "auc")])
    res = merged.withColumn("n_labels", F.lit(n_labels).cast("long"))
    reason = (F.when(F.col("n_preds") != F.col("n_labels"), "size_mismatch")
              .when(F.col("n_duplicate") > 0, "duplicate_key")
              .when(F.col("n_matched") != F.col("n_labels"), "size_mismatch")
              .when(F.col("n_nan") > 0, "nan")
              .when(F.col("n_inf") > 0, "inf")
              .when((F.col("n_pos") == 0) | (F.col("n_neg") == 0), "single_class"))
    return (res.withColumn("reason", reason)
               .withColumn("valid", F.col("reason").isNull())
               .withColumn("auc", F.when(F.col("valid"), F.col("auc"))))


def _per_key(preds: DataFrame, key: str, group: str, score: str, weights: DataFrame | None) -> DataFrame:
    """One row per key: the (weighted) mean of its models' scores and how many models it has; a repeated
    (key, model) counts once, with its mean score. Both steps share the shuffle by key."""
    one = preds.repartition(key).groupBy(key, group).agg(F.avg(score).alias("__p"))
    w = F.lit(1.0)
    if weights is not None:
        # (model, weight): a model-sized table; Spark broadcasts or shuffles it by its size
        one, w = one.join(weights.select(group, F.col("weight").alias("__w")), group), F.col("__w")
    return one.groupBy(key).agg(F.try_divide(F.sum(F.col("__p") * w), F.sum(w)).alias(score), F.count(F.lit(1)).alias("n_models"))


def ensemble_mean(preds: DataFrame, key: str = "key", group: str = "model_id", score: str = "p1",
                  weights: DataFrame | None = None) -> DataFrame:
    """Mean (or weighted mean, over the models that have a weight) of the k models' scores per key; keys
    missing one of them are left out (``ensemble_rejects`` lists them)."""
    k = (preds if weights is None else weights).select(F.count_distinct(group)).scalar()
    return _per_key(preds, key, group, score, weights).where(F.col("n_models") == k).drop("n_models")


def ensemble_rejects(preds: DataFrame, key: str = "key", group: str = "model_id", score: str = "p1") -> DataFrame:
    """Keys without a score of every model, ``(key, n_models)``."""
    k = preds.select(F.count_distinct(group)).scalar()
    return _per_key(preds, key, group, score, None).where(F.col("n_models") != k).select(key, "n_models")


def constant_baseline(labels: DataFrame, key: str = "key", value: float = 0.5, model_id: str = "baseline") -> DataFrame:
    """M9: the same probability for every row (AUC exactly 0.5)."""
    return labels.select(key, F.lit(model_id).alias("model_id"), F.lit(float(value)).alias("p1"))

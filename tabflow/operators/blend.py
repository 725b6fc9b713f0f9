"""Blend weights learnt from out-of-fold scores.

Greedy forward selection with replacement: starting from the best single model, each step adds the model whose
addition to the (unnormalised) sum of scores gives the highest AUC, and stops when none improves it. Weights are how
often a model was added. Adding a model again lets weights be any ratio, and a few steps rarely overfit.

A step scores all k candidate blends in one pass: every row of the wide score table yields one score per candidate, and
``metrics.auc_by_group`` computes the exact AUC of each candidate from its score groups, so nothing but k numbers reaches the
driver. Ties go to the model whose id sorts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import qcol
from .metrics import auc_by_group


def wide_scores(preds: DataFrame, labels: DataFrame, key: list[str], target: str = "target", group: str = "model_id",
                score: str = "p1") -> tuple[DataFrame, list[str]]:
    """``(target, s0, s1, ...)`` for the keys that every model scored, and the model ids in order (a model-sized list)."""
    ids = sorted(r[group] for r in preds.select(group).distinct().collect())
    per_key = preds.groupBy(*key).agg(*[F.avg(F.when(F.col(group) == m, F.col(score))).alias(f"s{i}") for i, m in enumerate(ids)])
    rows = per_key.join(labels.select(*key, F.col(target).cast("int").alias(target)), key).select(target, *[f"s{i}" for i in range(len(ids))])
    for i in range(len(ids)):
        rows = rows.where(F.col(f"s{i}").isNotNull() & ~F.isnan(f"s{i}"))
    return rows.checkpoint(), ids


def _blend(weights: list[int]) -> Column:
    """The weighted sum, always added up in the same order."""
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        if w:
            total = total + F.lit(float(w)) * qcol(f"s{i}")
    return total


def candidate_aucs(wide: DataFrame, candidates: list[list[int]], target: str = "target") -> list[float | None]:
    """Exact AUC of every candidate weighting, from one pass."""
    rows = wide.select(target, F.inline(F.array(*[F.struct(F.lit(str(j)).alias("model_id"), _blend(w).alias("p1")) for j, w in enumerate(candidates)])))
    got = {int(r["model_id"]): r["auc"] for r in auc_by_group(rows, target=target).collect()}
    return [got.get(j) for j in range(len(candidates))]


def greedy_weights(preds: DataFrame, labels: DataFrame, key: list[str], target: str = "target", max_steps: int = 20,
                   group: str = "model_id", score: str = "p1") -> tuple[dict[str, int], list[tuple[str, float]]]:
    """``({model: weight}, [(model added, AUC reached)])``; no weights without two classes or scored keys."""
    wide, ids = wide_scores(preds, labels, key, target, group, score)
    weights, steps, best = [0] * len(ids), [], None
    for _ in range(max_steps):
        tries = [[w + (i == j) for i, w in enumerate(weights)] for j in range(len(ids))]
        aucs = candidate_aucs(wide, tries, target)
        ranked = [(-a, j) for j, a in enumerate(aucs) if a is not None]
        if not ranked or best is not None and -min(ranked)[0] <= best:
            break
        best, j = -min(ranked)[0], min(ranked)[1]
        weights = tries[j]
        steps.append((ids[j], best))
    return {m: w for m, w in zip(ids, weights) if w}, steps


def weight_table(spark, weights: dict[str, int], group: str = "model_id") -> DataFrame:
    """The weights as ``metrics.ensemble_mean`` takes them."""
    return spark.createDataFrame([(m, float(w)) for m, w in weights.items()], f"`{group}` string, weight double")

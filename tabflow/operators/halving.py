"""Hyper-parameter search by successive halving.

All trials start on a small hash-chosen share of the training rows; after each rung the best ``1 / eta`` of them go on
with ``eta`` times the rows, until the last rung has all. Shares are nested (a row of a small share is in every larger one) and
pure functions of the key, so a rerun compares the same models. Trials are compared on an inner fold of train
that no trial is fitted on, by exact AUC; the winner is refitted on all of train and scored on val with the guarded AUC.

The feature chain is target-free and fitted once. Spark ML learners cannot be resumed from a smaller fit through the public
API, so a trial that goes on is fitted anew on the larger share; with a factor of 3 the rungs below the last cost less than
one and a half times the last.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import auc_by_group, evaluate
from .models import BOOSTED, _early_stop_flag, classifier, featurized, with_p1
from .split import split_hash

SPACE = 1 << 20
SHARE_SEED = 1042  # not the split's seed: its validation rows are the first in that hash order


def place(df: DataFrame, key: list[str], seed: int) -> Column:
    """A row's number in [0, 2^20), from the first five hex digits of the keyed md5."""
    return F.conv(F.substring(split_hash(df, key, seed), 1, 5), 16, 10).cast("long")


def rung_shares(n_trials: int, eta: int = 3) -> list[tuple[int, int]]:
    """``(trials, divisor)`` of every rung: the last has one divisor 1 and at most ``eta`` trials."""
    sizes = [n_trials]
    while sizes[-1] > eta:
        sizes.append(-(-sizes[-1] // eta))
    return [(n, eta ** (len(sizes) - 1 - i)) for i, n in enumerate(sizes)]


def search(split_df: DataFrame, roles: dict[str, list[str]], key: list[str], trials: list[dict], kind: str = "lr", target: str = "target",
           eta: int = 3, inner: float = 0.2, parallelism: int = 4, params: dict | None = None, seed: int = SHARE_SEED) -> tuple[DataFrame, DataFrame]:
    """``(trial table, metrics of the winner)``.

    The trial table has a row per trial and rung: ``(rung, trial, params, n_train, n_inner, auc, kept)``; equal AUCs: the earlier
    trial. ``params`` are settings that all trials share.
    """
    spark = split_df.sparkSession
    feats = featurized(split_df, roles, key, target)
    train = feats.where(F.col("split") == "train").withColumn("__place", place(feats, key, seed)).withColumn("__inner", place(feats, key, seed + 1))
    if kind in BOOSTED:
        train = _early_stop_flag(train, key)
    fold = F.col("__inner") < int(inner * SPACE)
    held, rest = train.where(fold), train.where(~fold)
    n_inner, alive, rows = held.count(), list(range(len(trials))), []
    for rung, (n, divisor) in enumerate(rung_shares(len(trials), eta)):
        part = rest.where(F.col("__place") < SPACE // divisor).persist()
        n_train = part.count()

        def run(t: int, part=part) -> float | None:
            model = classifier(kind, target, params={**(params or {}), **trials[t]}).fit(part)
            scored = with_p1(model.transform(held)).select(F.lit(str(t)).alias("model_id"), "p1", F.col(target).cast("int").alias(target))
            got = auc_by_group(scored, target=target).first()
            return got["auc"] if got else None

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            aucs = list(pool.map(inheritable_thread_target(run), alive))
        part.unpersist()
        ranked = sorted(zip(aucs, alive), key=lambda x: (-(x[0] if x[0] is not None else -1.0), x[1]))
        last = divisor == 1
        stay = {t for _, t in ranked[:1 if last else -(-n // eta)]}
        rows += [(rung, t, json.dumps(trials[t], sort_keys=True), n_train, n_inner, a, t in stay) for a, t in zip(aucs, alive)]
        alive = [t for t in alive if t in stay]
    final = train if kind in BOOSTED else train.drop("__place", "__inner")
    winner = classifier(kind, target, params={**(params or {}), **trials[alive[0]]}).fit(final)
    val = feats.where(F.col("split") == "val")
    preds = with_p1(winner.transform(val)).select(*key, F.lit(f"halving_{kind}").alias("model_id"), "p1")
    res = evaluate(preds, val.select(*key, target), key=key, target=target).checkpoint()
    feats.unpersist()
    table = spark.createDataFrame(rows, "rung int, trial int, params string, n_train long, n_inner long, auc double, kept boolean")
    return table, res.withColumn("best_trial", F.lit(alive[0])).withColumn("best_params", F.lit(json.dumps(trials[alive[0]], sort_keys=True)))

"""Learnt blend weights equal a brute force; halving keeps the best and is nested."""

import random

import pytest

from tabflow.operators import blend as B
from tabflow.operators import halving as HV


def auc_brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def greedy_brute(cols, labels, max_steps):
    w, best, steps = [0] * len(cols), None, []
    for _ in range(max_steps):
        tries = []
        for j in range(len(cols)):
            v = [x + (i == j) for i, x in enumerate(w)]
            total = [0.0] * len(labels)
            for x, c in zip(v, cols):
                if x:
                    total = [t + float(x) * s for t, s in zip(total, c)]
            tries.append((-auc_brute(total, labels), j, v))
        a, j, v = min(tries)
        if best is not None and -a <= best + 1e-15:
            break
        best, w = -a, v
        steps.append(j)
    return w, steps, best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_weights_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    n, k = 160, 4
    y = [int(rnd.random() < 0.4) for _ in range(n)]
    cols = [[round(rnd.gauss(0.4 * (j + 1) * t, 1), 1 + j % 2) for t in y] for j in range(k)]
    preds = spark.createDataFrame([(i, f"m{j}", cols[j][i]) for j in range(k) for i in range(n)], "key long, model_id string, p1 double").repartition(4)
    labels = spark.createDataFrame(list(enumerate(y)), "key long, target int")
    weights, steps = B.greedy_weights(preds, labels, ["key"], max_steps=6)
    w, picked, best = greedy_brute(cols, y, 6)
    assert weights == {f"m{j}": x for j, x in enumerate(w) if x}
    assert [m for m, _ in steps] == [f"m{j}" for j in picked] and steps[-1][1] == pytest.approx(best, abs=1e-12)
    assert B.weight_table(spark, weights).count() == len(weights)


def test_no_weights_without_two_classes_or_common_keys(spark):
    preds = spark.createDataFrame([(1, "a", 0.5), (2, "b", 0.5)], "key long, model_id string, p1 double")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "key long, target int")
    assert B.greedy_weights(preds, labels, ["key"]) == ({}, [])
    both = preds.unionByName(spark.createDataFrame([(2, "a", 0.1), (1, "b", float("nan"))], preds.schema))
    assert B.greedy_weights(both, labels.withColumn("target", labels.target * 0), ["key"]) == ({}, [])


@pytest.mark.parametrize("n,want", [(1, [(1, 1)]), (3, [(3, 1)]), (15, [(15, 9), (5, 3), (2, 1)]), (27, [(27, 9), (9, 3), (3, 1)])])
def test_rungs(n, want):
    assert HV.rung_shares(n) == want

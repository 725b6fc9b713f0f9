"""Generated cases: quota invariants (pure Python) and AUC against brute force (Spark, few examples)."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabflow.operators import metrics as M
from tabflow.operators import split as S


@given(st.dictionaries(st.integers(0, 5), st.integers(2, 5000), min_size=2, max_size=6),
       st.sampled_from([0.1, 0.2, 0.25, 0.3, 0.5]))
@settings(max_examples=300, deadline=None)
def test_quotas_are_exact_and_proportional(counts, test_size):
    n = sum(counts.values())
    n_val = math.ceil(round(test_size * n, 9))
    if n - n_val < len(counts) or n_val < len(counts):
        with pytest.raises(ValueError):
            S.quotas(counts, test_size)
        return
    q = S.quotas(counts, test_size)
    assert sum(q.values()) == n_val
    n_train = n - n_val
    for c, k in counts.items():
        train_c = k - q[c]
        assert math.floor(k * n_train / n) <= train_c <= math.floor(k * n_train / n) + 1


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=4, max_size=60))
@settings(max_examples=8, deadline=None)
def test_auc_equals_pair_count(spark, rows):
    labels = {y for y, _ in rows}
    df = spark.createDataFrame([(y, s / 3.0) for y, s in rows], "target int, p1 double")
    got = M.auc_by_group(df.select(F.lit("m").alias("model_id"), "p1", "target"), n_buckets=3).first()
    if labels != {0, 1}:
        assert got is None or got["auc"] is None
        return
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert got["auc"] == pytest.approx(brute, abs=1e-12)

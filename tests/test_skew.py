"""A hot key holding a third of all rows: results stay exact and the work stays split."""

import random

import pytest
from pyspark.sql import functions as F

from tabflow.operators import metrics as M
from tabflow.operators import ranking as R
from tabflow.operators import split as S


@pytest.fixture(scope="module")
def hot(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(3000):
        grp = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 40)}"
        rows.append((i, grp, rnd.random(), int(rnd.random() < 0.3)))
    return rows, spark.createDataFrame(rows, "seq long, grp string, v double, y int")


def test_running_sum_hot_group_spreads_and_is_exact(spark, hot):
    rows, df = hot
    out = R.running(df, "seq", "v", "sum", ("grp",), True, "s", n_buckets=16)
    got = {r["seq"]: r["s"] for r in out.collect()}
    acc = {}
    for seq, g, v, _ in rows:
        assert got[seq] == pytest.approx(acc.get(g, 0.0), abs=1e-9)
        acc[g] = acc.get(g, 0.0) + v
    staged = R.with_buckets(df, ["seq"], ["b"], 16)
    assert staged.where(F.col("grp") == "hot").select("b").distinct().count() >= 12


def test_auc_with_one_score_holding_a_third(spark, hot):
    rows, _ = hot
    data = [(i, y, 0.5 if i % 3 == 0 else round(v, 2)) for i, _, v, y in rows]
    df = spark.createDataFrame(data, "key long, target int, p1 double")
    pos = [s for _, y, s in data if y == 1]
    neg = [s for _, y, s in data if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    g = df.select(F.lit("m").alias("model_id"), "p1", "target")
    assert M.auc_by_group(g, n_buckets=8).first()["auc"] == pytest.approx(brute, abs=1e-12)


def test_split_with_dominant_class(spark):
    df = spark.range(6000).select(F.col("id").alias("key"), F.when(F.col("id") % 50 == 0, 1).otherwise(0).alias("target"))
    sp = S.stratified_split(df, "key")
    got = {(r["target"], r["split"]): r["count"] for r in sp.groupBy("target", "split").count().collect()}
    assert got == {(0, "train"): 4704, (0, "val"): 1176, (1, "train"): 96, (1, "val"): 24}


def test_frequency_encoder_same_result_by_shuffle_or_broadcast(spark):
    from tabflow.operators import encode as E
    rows = [(i, None if i % 3 else f"v{i % 7}") for i in range(900)]
    df = spark.createDataFrame(rows, "key long, `a.b` string")

    def run():
        enc = E.FrequencyEncoder(inputCols=["a.b"], outputCols=["f"])
        return {r["key"]: r["f"] for r in enc.fit(df).transform(df).collect()}

    want = run()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    non_null = [v for _, v in rows if v is not None]
    assert got == want and got[1] == 0.0
    assert abs(got[0] - non_null.count("v0") / len(non_null)) < 1e-12


def test_distinct_counts_stay_exact(spark):
    from tabflow.operators import profile as P
    df = spark.range(1_200_000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("word"))
    assert P.profile(df, target=None).first()["n_unique"] == 1_200_000


def test_prefixes_do_not_depend_on_shuffle_partitions(spark):
    from tabflow.operators import ranking as R
    assert R.default_buckets(spark.range(1)) == R.N_BUCKETS
    rows = [(None if i % 3 == 0 else f"g{i % 3}", f"k{i:05d}", i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, k string, v long").repartition(6)
    got = {r["k"]: r["running"] for r in R.running(df, "k", "v", partition_cols=("g",), exclusive=False).collect()}
    total, want = {}, {}
    for g, k, v in rows:
        total[g] = total.get(g, 0) + v
        want[k] = total[g]
    assert got == want


def test_median_of_all_null_column(spark):
    from tabflow.operators import stats
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "a double, b double")
    got = {r["column"]: r["median"] for r in stats.exact_medians(df, ["a", "b"], n_buckets=4).collect()}
    assert got == {"a": 2.0, "b": None}

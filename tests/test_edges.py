"""Edge fixtures (FIXTURES.md section 3): small inline tables with hand-checked answers."""

import math

import pytest
from pyspark.sql import functions as F

from tabflow.operators import attempts as A
from tabflow.operators import encode as E
from tabflow.operators import ledger as L
from tabflow.operators import metrics as M
from tabflow.operators import profile as P
from tabflow.operators import split as S
from tabflow.operators import stats
from tabflow.sources.tables import nan_to_null, require_unique_key

LABELLED_SCHEMA = ("key bigint, total_price double, acct_bal double, nation_key int, priority string, "
                   "segment string, stock_code string, customer_id string, target int")


def test_empty_labelled(spark):
    df = spark.createDataFrame([], LABELLED_SCHEMA)
    prof = P.profile_table(P.profile(df)).collect()
    assert len(prof) == 8
    assert all(r["mean"] is None and r["null_pct"] is None for r in prof)
    labels = df.select("key", "target")
    ev = M.evaluate(M.constant_baseline(labels), labels).collect()
    assert ev == [] or ev[0]["auc"] is None


def test_one_class(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(4)], "key long, target int")
    preds = labels.select("key", F.lit("m").alias("model_id"), (F.col("key") / 10).alias("p1"))
    r = M.evaluate(preds, labels).collect()[0]
    assert r["auc"] is None and r["reason"] == "single_class" and not r["valid"]


def test_lone_class_row_raises(spark):
    df = spark.createDataFrame([(i, 0) for i in range(9)] + [(9, 1)], "key long, target int")
    with pytest.raises(ValueError):
        S.stratified_split(df, "key", "target")


def test_nan_inf_guards(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "key long, target int")
    vals = [0.1, float("nan"), float("inf"), float("-inf"), None]
    rows = []
    for j, bad in enumerate(vals):
        for i in range(5):
            rows.append((f"m{j}", i, bad if i == 0 else 0.3 + i / 10))
    preds = spark.createDataFrame(rows, "model_id string, key long, p1 double")
    got = {r["model_id"]: r["reason"] for r in M.evaluate(preds, labels).collect()}
    assert got == {"m0": None, "m1": "nan", "m2": "inf", "m3": "inf", "m4": "nan"}


def test_missing_keys_size_mismatch(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "key long, target int")
    preds = spark.createDataFrame([("m", 1, 0.2), ("m", 2, 0.8), ("m", 99, 0.5)], "model_id string, key long, p1 double")
    r = M.evaluate(preds, labels).collect()[0]
    assert r["reason"] == "size_mismatch" and r["auc"] is None


def test_dup_keys_raise(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "key long, target int")
    with pytest.raises(ValueError):
        require_unique_key(df, ["key"])


def test_all_null_column(spark):
    df = spark.createDataFrame([(i, None, i % 2) for i in range(6)], "key long, x double, target int")
    r = {x["column"]: x for x in P.profile(df).collect()}["x"]
    assert r["null_pct"] == 100.0 and r["mean"] is None and r["std"] is None and r["min"] is None


def test_nan_is_null_at_load(spark):
    df = nan_to_null(spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double"))
    r = df.agg(F.avg("x").alias("a"), F.count("x").alias("n")).first()
    assert r["a"] == 2.0 and r["n"] == 2
    m = stats.exact_medians(df, ["x"]).first()
    assert m["median"] == 2.0


def test_unseen_category(spark):
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "train"), (3, "c", "val"), (4, None, "val")],
                               "key long, cat string, split string")
    model = E.label_encoder(["cat"]).fit(df.where("split = 'train'"))
    codes = {r["key"]: r["cat_code"] for r in E.apply_label_codes(model, df, ["cat"]).collect()}
    assert codes == {1: 0, 2: 1, 3: 2, 4: 2}  # reserved code = number of classes
    fe = E.FrequencyEncoder(inputCols=["cat"], outputCols=["cat_f"]).fit(df.where("split = 'train'"))
    freqs = {r["key"]: r["cat_f"] for r in fe.transform(df).collect()}
    assert freqs == {1: 0.5, 2: 0.5, 3: 0.0, 4: 0.0}
    unseen = {(r["value"], r["rows"]) for r in E.unseen_categories(df, ["cat"]).collect()}
    assert unseen == {("c", 1), ("__nan__", 1)}


def test_top5_tie_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "gfedcba" for _ in range(3)], "c string")
    got = [(r["value"], r["rank"]) for r in P.top_values(df, ["c"], 5).orderBy("rank").collect()]
    assert got == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]


def _distinct_col(n, total=1100):
    return [f"v{i % n}" for i in range(total)]


def test_distinct_edges_and_width(spark):
    cols = {"x50": 50, "x51": 51, "x_id1000": 1000, "x_id1001": 1001, "width": 1001, "plain1001": 1001}
    data = list(zip(*[_distinct_col(n) for n in cols.values()]))
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    roles = {r["column"]: r["role"] for r in P.profile(df, target=None).collect()}
    assert roles == {"x50": "categorical", "x51": "high_cardinality", "x_id1000": "high_cardinality",
                     "x_id1001": "id_like", "width": "id_like", "plain1001": "high_cardinality"}


def test_numeric_id_is_never_id_like(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(2000)], "id long, target int")
    assert P.roles(P.profile(df))["numeric"] == ["id"]


def test_no_success_log(spark):
    df = spark.createDataFrame([(i, None, "boom") for i in range(3)], "attempt_seq long, roc_auc double, error string")
    assert A.best(df).collect() == []
    failed = A.failed_approaches(df.withColumn("approach_description", F.lit("x"))).count()
    assert failed == 3
    st = {r["s"] for r in df.select(A.status().alias("s")).collect()}
    assert st == {"error"}


def test_status_rules(spark):
    df = spark.createDataFrame([("", 0.0), (None, None), ("e", 0.9), ("", None)], "error string, roc_auc double")
    assert [r["s"] for r in df.select(A.status().alias("s")).collect()] == ["success", "no_metric", "error", "no_metric"]


def test_best_tie_earliest_wins(spark):
    df = spark.createDataFrame([(1, 0.7), (2, 0.9), (3, 0.9), (4, None)], "attempt_seq long, roc_auc double")
    assert A.best(df).first()["attempt_seq"] == 2


def test_budget_edge_exact_limit_refused(spark):
    # 1,000,000 input tokens of deepseek-r1 cost exactly 0.45 USD
    usage = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", "deepseek/deepseek-r1", 1_000_000, 0),
         (2, "2024-01-01 01:00:00", "deepseek/deepseek-r1", 1_000_000, 0),
         (3, "2024-01-01 02:00:00", "other/unknown", 0, 0)],
        "call_seq long, ts string, model string, input_tokens long, output_tokens long"
    ).withColumn("ts", F.to_timestamp("ts"))
    adm = {r["call_seq"]: r["admitted"] for r in L.admission(L.with_cost(usage), limit=0.90).collect()}
    assert adm == {1: True, 2: True, 3: False}  # spend before call 3 is exactly 0.90: not < limit
    st = L.budget_status(L.daily_usage(L.with_cost(usage)), 0.90).first()
    assert st["spent_usd"] == 0.9 and st["can_continue"] is False


def test_unknown_model_default_price(spark):
    usage = spark.createDataFrame([(1, "x/y", 1_000_000, 1_000_000)],
                                  "call_seq long, model string, input_tokens long, output_tokens long")
    assert math.isclose(L.with_cost(usage).first()["cost_usd"], 0.55 + 2.19)


def test_constant_score_auc_half(spark):
    labels = spark.createDataFrame([(i, i % 3 == 0 and 1 or 0) for i in range(30)], "key long, target int")
    r = M.evaluate(M.constant_baseline(labels), labels).first()
    assert r["auc"] == 0.5 and r["valid"]


def test_median_imputer_stage_is_exact(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 4.0, None), (3, None, None), (4, 10.0, None), (5, 2.0, None)],
                               "key long, x double, y double")
    m = E.MedianImputer(inputCols=["x", "y"], outputCols=["x_m", "y_m"]).fit(df)
    got = {r["key"]: (r["x_m"], r["y_m"]) for r in m.transform(df).collect()}
    assert got[3] == (3.0, None)  # median of 1, 2, 4, 10 is 3.0 (interpolated); all-null y stays null
    assert got[1] == (1.0, None)


def test_profile_column_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(1.0, "a", 0), (None, "b", 1)], "`x.y` double, `a b` string, target int")
    got = {r["column"]: (r["role"], r["null_pct"]) for r in P.profile(df).collect()}
    assert got == {"x.y": ("numeric", 50.0), "a b": ("categorical", 0.0)}
    assert P.top_values(df, ["a b"], 5).count() == 2


def test_median_of_dotted_column_name(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "`p.q` double")
    assert stats.exact_medians(df, ["p.q"], n_buckets=4).first()["median"] == 2.0


def test_boolean_labels(spark):
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(6)], "key long, target boolean")
    preds = labels.select("key", F.lit("m").alias("model_id"), F.col("key").cast("double").alias("p1"))
    r = M.evaluate(preds, labels).first()
    assert r["valid"] and r["auc"] == pytest.approx(2 / 3)

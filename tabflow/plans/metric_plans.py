"""Registered metric queries: guarded AUC, ensembles, baseline, ranks and row ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import ranking as R
from ..sources import fixtures as fx
from .registry import register
from .split_plans import SPLIT_CTES, labelled_split

_AUC_CTES = """,
j AS (SELECT p.model_id, p.p1, l.target FROM predictions p JOIN labelled l ON p.key = l.key),
r AS (SELECT model_id, target,
             rank() OVER (PARTITION BY model_id ORDER BY p1) + (count(*) OVER (PARTITION BY model_id, p1) - 1) / 2.0 AS ar
      FROM j),
s AS (SELECT model_id, sum(CASE WHEN target = 1 THEN ar ELSE 0 END) AS rpos,
             CAST(count_if(target = 1) AS DOUBLE) AS np, CAST(count_if(target = 0) AS DOUBLE) AS nn
      FROM r GROUP BY model_id)
"""


def _auc_sql(select: str, preds_view: str = "predictions", preds_sql: str | None = None) -> str:
    if preds_sql is None:
        head = fx.with_views("", "labelled", "predictions").rstrip()
    else:
        head = fx.with_views("", "labelled", extra={"predictions": preds_sql}).rstrip()
    return head + _AUC_CTES + select


def _labels(spark, sf_dir):
    return fx.labelled(spark, sf_dir).select("key", "target")


@register("roc_auc", "A18 J4 P7", _auc_sql(
    "SELECT model_id, round((rpos - np * (np + 1) / 2) / (np * nn), 10) AS auc FROM s"))
def roc_auc(spark, sf_dir):
    ev = M.evaluate(fx.predictions(spark, sf_dir), _labels(spark, sf_dir))
    return ev.select("model_id", F.round("auc", 10).alias("auc"))


@register("prediction_guard", "P11 J4", fx.with_views(
    """SELECT p.model_id, p.n_preds, l.n_labels, m.n_matched, p.n_nan, p.n_inf, m.n_pos, m.n_neg,
       CASE WHEN p.n_preds <> l.n_labels OR m.n_matched <> l.n_labels THEN 'size_mismatch'
            WHEN p.n_nan > 0 THEN 'nan' WHEN p.n_inf > 0 THEN 'inf'
            WHEN m.n_pos = 0 OR m.n_neg = 0 THEN 'single_class' END AS reason,
       NOT (p.n_preds <> l.n_labels OR m.n_matched <> l.n_labels OR p.n_nan > 0 OR p.n_inf > 0
            OR m.n_pos = 0 OR m.n_neg = 0) AS valid
FROM (SELECT model_id, count(*) AS n_preds, CAST(count_if(p1 IS NULL OR isnan(p1)) AS BIGINT) AS n_nan,
             CAST(count_if(isinf(p1)) AS BIGINT) AS n_inf FROM predictions GROUP BY model_id) p
CROSS JOIN (SELECT count(*) AS n_labels FROM labelled) l
JOIN (SELECT p.model_id, count(*) AS n_matched, CAST(count_if(l.target = 1) AS BIGINT) AS n_pos,
             CAST(count_if(l.target = 0) AS BIGINT) AS n_neg
      FROM predictions p JOIN labelled l ON p.key = l.key GROUP BY p.model_id) m ON p.model_id = m.model_id""",
    "labelled", "predictions"))
def prediction_guard(spark, sf_dir):
    ev = M.evaluate(fx.predictions(spark, sf_dir), _labels(spark, sf_dir))
    return ev.select("model_id", "n_preds", "n_labels", "n_matched", "n_nan", "n_inf", "n_pos", "n_neg",
                     "reason", "valid")


_ENSEMBLE_SQL = ("SELECT key, 'ensemble' AS model_id, avg(p1) AS p1 FROM predictions GROUP BY key "
                 "HAVING count(DISTINCT model_id) = (SELECT count(DISTINCT model_id) FROM predictions)")


@register("ensemble_mean", "A21 M13", fx.with_views(
    "SELECT key, round(p1, 12) AS p1 FROM ens", "predictions", extra={"ens": _ENSEMBLE_SQL}))
def ensemble_mean(spark, sf_dir):
    e = M.ensemble_mean(fx.predictions(spark, sf_dir))
    return e.select("key", F.round("p1", 12).alias("p1"))


@register("ensemble_auc", "A21 A18 M13", fx.with_views("", "labelled", "predictions").rstrip()
          + ",\nens AS (" + _ENSEMBLE_SQL + ")" + _AUC_CTES.replace("FROM predictions p", "FROM ens p")
          + "SELECT model_id, round((rpos - np * (np + 1) / 2) / (np * nn), 10) AS auc FROM s")
def ensemble_auc(spark, sf_dir):
    e = M.ensemble_mean(fx.predictions(spark, sf_dir)).withColumn("model_id", F.lit("ensemble"))
    ev = M.evaluate(e, _labels(spark, sf_dir))
    return ev.select("model_id", F.round("auc", 10).alias("auc"))


@register("baseline_auc", "M9 A18", fx.with_views(
    "SELECT 'baseline' AS model_id, CAST(0.5 AS DOUBLE) AS auc, "
    "CASE WHEN count_if(target = 1) > 0 AND count_if(target = 0) > 0 THEN TRUE ELSE FALSE END AS valid FROM labelled",
    "labelled"))
def baseline_auc(spark, sf_dir):
    labels = _labels(spark, sf_dir)
    ev = M.evaluate(M.constant_baseline(labels), labels)
    return ev.select("model_id", F.round("auc", 10).alias("auc"), "valid")


@register("submission", "S9 J5 P7", fx.with_views(
    "SELECT l.key AS id, round(e.p1, 12) AS target FROM labelled l LEFT JOIN ens e ON l.key = e.key",
    "labelled", "predictions", extra={"ens": _ENSEMBLE_SQL}))
def submission(spark, sf_dir):
    test = fx.labelled(spark, sf_dir).select("key")
    e = M.ensemble_mean(fx.predictions(spark, sf_dir))
    return test.join(e, "key", "left").select(F.col("key").alias("id"), F.round("p1", 12).alias("target"))


@register("sequential_ids", "W5", fx.with_views(
    "SELECT key, row_number() OVER (ORDER BY key) - 1 AS row_id FROM labelled", "labelled"))
def sequential_ids(spark, sf_dir):
    df = fx.labelled(spark, sf_dir).select("key")
    return R.row_index(df, "key", "row_id").select("key", "row_id")


@register("rank_transform", "W4", fx.with_views(
    "SELECT key, CASE WHEN total_price IS NULL THEN NULL ELSE round((rank() OVER (ORDER BY total_price) "
    "+ (count(*) OVER (PARTITION BY total_price) - 1) / 2.0) / (SELECT count(total_price) FROM labelled), 12) END "
    "AS total_price_rank FROM labelled", "labelled"))
def rank_transform(spark, sf_dir):
    df = fx.labelled(spark, sf_dir).select("key", "total_price")
    r = R.average_rank(df, "total_price", "total_price_rank")
    return r.select("key", F.round("total_price_rank", 12).alias("total_price_rank"))


_STEPS = 4
_BLEND_SQL = fx.with_views("", "labelled", "predictions").rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + f""",
wide AS (SELECT l.target, CASE WHEN l.key % 2 = 0 THEN a.p1 ELSE 0.03 END AS s1, b.p1 AS s2, CASE WHEN l.key % 2 = 1 THEN a.p1 ELSE 0.03 END AS s3
         FROM labelled l JOIN predictions a ON a.key = l.key AND a.model_id = 'm1' JOIN predictions b ON b.key = l.key AND b.model_id = 'm2'),
w AS (SELECT a.i AS w1, b.i AS w2, c.i AS w3 FROM range({_STEPS + 1}) a(i), range({_STEPS + 1}) b(i), range({_STEPS + 1}) c(i) WHERE a.i + b.i + c.i BETWEEN 1 AND {_STEPS}),
cand AS (SELECT w1, w2, w3, target, CAST(w1 AS DOUBLE) * s1 + CAST(w2 AS DOUBLE) * s2 + CAST(w3 AS DOUBLE) * s3 AS p FROM wide, w),
rk AS (SELECT w1, w2, w3, target, rank() OVER (PARTITION BY w1, w2, w3 ORDER BY p) + (count(*) OVER (PARTITION BY w1, w2, w3, p) - 1) / 2.0 AS ar FROM cand),
auc AS MATERIALIZED (SELECT w1, w2, w3, (sum(CASE WHEN target = 1 THEN ar ELSE 0 END) - np * (np + 1) / 2) / (np * nn) AS auc FROM rk,
        (SELECT CAST(count_if(target = 1) AS DOUBLE) AS np, CAST(count_if(target = 0) AS DOUBLE) AS nn FROM wide) n GROUP BY w1, w2, w3, np, nn),
walk(w1, w2, w3, auc) AS (SELECT 0, 0, 0, CAST(-1 AS DOUBLE) UNION ALL
  SELECT n.w1, n.w2, n.w3, n.auc FROM (SELECT a.*, row_number() OVER (ORDER BY a.auc DESC, a.w1 DESC, a.w2 DESC) AS rn, k.auc AS before FROM walk k JOIN auc a
    ON a.w1 + a.w2 + a.w3 = k.w1 + k.w2 + k.w3 + 1 AND a.w1 >= k.w1 AND a.w2 >= k.w2 AND a.w3 >= k.w3) n WHERE n.rn = 1 AND n.auc > n.before),
best AS (SELECT * FROM walk ORDER BY auc DESC LIMIT 1)
SELECT model_id, weight, round(auc, 9) AS blend_auc FROM (SELECT 'even' AS model_id, CAST(w1 AS BIGINT) AS weight, auc FROM best UNION ALL SELECT 'm2', w2, auc FROM best
  UNION ALL SELECT 'odd', w3, auc FROM best) b WHERE weight > 0"""


@register("blend_weights", "M13 A18", _BLEND_SQL)
def blend_weights(spark, sf_dir):
    """Learnt weights of three models, two of which know one half of the rows each, and the AUC their blend reaches."""
    from ..operators import blend as B
    lab, p = fx.labelled(spark, sf_dir), fx.predictions(spark, sf_dir)
    half = [p.where("model_id = 'm1'").withColumn("p1", F.when(F.col("key") % 2 == i, F.col("p1")).otherwise(0.03)).withColumn("model_id", F.lit(m))
            for i, m in enumerate(("even", "odd"))]
    three = p.where("model_id = 'm2'").unionByName(half[0]).unionByName(half[1])
    weights, steps = B.greedy_weights(three, lab.select("key", "target"), ["key"], max_steps=_STEPS)
    return B.weight_table(spark, weights).select("model_id", F.col("weight").cast("bigint").alias("weight"), F.round(F.lit(steps[-1][1]), 9).alias("blend_auc"))


_FITTED_RANK = ", ".join(f"""g_{c} AS (SELECT v, sum(c) AS c FROM (SELECT CAST({c} AS DOUBLE) AS v, count(*) AS c FROM assigned WHERE split = 'train' AND {c} IS NOT NULL GROUP BY 1
  UNION ALL SELECT DISTINCT CAST({c} AS DOUBLE), 0 FROM assigned WHERE {c} IS NOT NULL) u GROUP BY v),
r_{c} AS (SELECT v, (coalesce(sum(c) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (c + 1) / 2.0) / sum(c) OVER () AS r FROM g_{c})"""
                         for c in ("total_price", "nation_key"))


@register("rank_transform_fitted", "W4", fx.with_views("", "labelled").rstrip() + "," + SPLIT_CTES + "," + _FITTED_RANK
          + "\nSELECT a.key, a.split, round(p.r, 9) AS total_price_rank, round(n.r, 9) AS nation_key_rank FROM assigned a "
            "LEFT JOIN r_total_price p ON a.total_price = p.v LEFT JOIN r_nation_key n ON CAST(a.nation_key AS DOUBLE) = n.v")
def rank_transform_fitted(spark, sf_dir):
    """Ranks among the training rows for every row, ties and values that training does not hold included."""
    from ..operators.ranks import RankTransform
    cols = ["total_price", "nation_key"]
    sp = labelled_split(spark, sf_dir).select("key", "split", *cols)
    model = RankTransform(inputCols=cols, outputCols=[f"{c}_rank" for c in cols]).fit(sp.where(F.col("split") == "train"))
    return model.transform(sp).select("key", "split", *[F.round(f"{c}_rank", 9).alias(f"{c}_rank") for c in cols])


@register("roc_auc_big", "A18", fx.with_views(
    "SELECT model_id, round((rpos - np * (np + 1) / 2) / (np * nn), 10) AS auc FROM ("
    "SELECT model_id, sum(CASE WHEN target = 1 THEN ar ELSE 0 END) AS rpos, "
    "CAST(count_if(target = 1) AS DOUBLE) AS np, CAST(count_if(target = 0) AS DOUBLE) AS nn FROM ("
    "SELECT 'l_discount' AS model_id, target, rank() OVER (ORDER BY l_discount) "
    "+ (count(*) OVER (PARTITION BY l_discount) - 1) / 2.0 AS ar FROM labelled_big) r GROUP BY model_id) s",
    "labelled_big"))
def roc_auc_big(spark, sf_dir):
    big = fx.labelled_big(spark, sf_dir).select(F.lit("l_discount").alias("model_id"),
                                                F.col("l_discount").alias("p1"), "target")
    return M.auc_by_group(big).select("model_id", F.round("auc", 10).alias("auc"))


@register("submission_without_id", "S9 W5 J5", fx.with_views(
    "SELECT row_number() OVER (ORDER BY l.key) - 1 AS id, round(e.p1, 12) AS target "
    "FROM labelled l LEFT JOIN ens e ON l.key = e.key",
    "labelled", "predictions", extra={"ens": _ENSEMBLE_SQL}))
def submission_without_id(spark, sf_dir):
    # the test table has no id column: ids are 0..n-1 in key order (never monotonically_increasing_id)
    test = R.row_index(fx.labelled(spark, sf_dir).select("key"), "key", "id")
    e = M.ensemble_mean(fx.predictions(spark, sf_dir))
    return test.join(e, "key", "left").select("id", F.round("p1", 12).alias("target"))


# ---------------------------------------------------------------- rejected predictions, weights, text keys

_BAD_SQL = """
SELECT key, 'nan' AS model_id, CASE WHEN key % 101 = 0 THEN CAST('NaN' AS DOUBLE) ELSE p1 END AS p1 FROM predictions WHERE model_id = 'm1'
UNION ALL SELECT key, 'inf', CASE WHEN key % 103 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE p1 END FROM predictions WHERE model_id = 'm1'
UNION ALL SELECT key, 'missing', p1 FROM predictions WHERE model_id = 'm1' AND key % 7 <> 0
UNION ALL SELECT CASE WHEN key % 50 = 0 THEN (SELECT min(key) FROM labelled) ELSE key END, 'duplicate', p1 FROM predictions WHERE model_id = 'm1'
UNION ALL SELECT CASE WHEN key % 50 = 0 THEN -key ELSE key END, 'uncovered', p1 FROM predictions WHERE model_id = 'm1'
UNION ALL SELECT key, NULL, p1 FROM predictions WHERE model_id = 'm2'"""


def _bad_predictions(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    m1, key = p.where(F.col("model_id") == "m1"), F.col("key")
    low = fx.labelled(spark, sf_dir).select(F.min("key")).scalar()
    cases = [
        m1.select("key", F.lit("nan").alias("model_id"), F.when(key % 101 == 0, float("nan")).otherwise(F.col("p1")).alias("p1")),
        m1.select("key", F.lit("inf").alias("model_id"), F.when(key % 103 == 0, float("inf")).otherwise(F.col("p1")).alias("p1")),
        m1.where(key % 7 != 0).select("key", F.lit("missing").alias("model_id"), "p1"),
        m1.select(F.when(key % 50 == 0, low).otherwise(key).alias("key"), F.lit("duplicate").alias("model_id"), "p1"),
        m1.select(F.when(key % 50 == 0, -key).otherwise(key).alias("key"), F.lit("uncovered").alias("model_id"), "p1"),
        p.where(F.col("model_id") == "m2").select("key", F.lit(None).cast("string").alias("model_id"), "p1"),
    ]
    out = cases[0]
    for c in cases[1:]:
        out = out.unionByName(c)
    return out


@register("prediction_guard_bad", "P11 J4 A18", _auc_sql("", preds_sql=fx.VIEW_SQL["predictions"]).split(",\nj AS")[0].rstrip() + ",\nbad AS ("
          + _BAD_SQL + """),
per AS (SELECT p.model_id, p.key, count(*) AS c, max(l.target) AS target, max(l.key) AS known,
               count_if(p.p1 IS NULL OR isnan(p.p1)) AS nn, count_if(isinf(p.p1)) AS ni, min(p.p1) AS p1
        FROM bad p LEFT JOIN labelled l ON p.key = l.key GROUP BY p.model_id, p.key),
st AS (SELECT model_id, sum(c) AS n_preds, count(known) AS n_matched, count_if(c > 1) AS n_dup, sum(nn) AS nn, sum(ni) AS ni FROM per GROUP BY model_id),
j2 AS (SELECT p.model_id, p.p1, l.target FROM bad p JOIN labelled l ON p.key = l.key WHERE p.model_id IS NULL),
r2 AS (SELECT target, rank() OVER (ORDER BY p1) + (count(*) OVER (PARTITION BY p1) - 1) / 2.0 AS ar FROM j2),
s2 AS (SELECT sum(CASE WHEN target = 1 THEN ar ELSE 0 END) AS rp, CAST(count_if(target = 1) AS DOUBLE) AS np, CAST(count_if(target = 0) AS DOUBLE) AS ng FROM r2),
v AS (SELECT st.*, (SELECT count(*) FROM labelled) AS n_labels FROM st)
SELECT model_id, CAST(n_preds AS BIGINT) AS n_preds, n_matched, CAST(n_dup AS BIGINT) AS n_duplicate,
       CASE WHEN n_preds <> n_labels THEN 'size_mismatch' WHEN n_dup > 0 THEN 'duplicate_key' WHEN n_matched <> n_labels THEN 'size_mismatch'
            WHEN nn > 0 THEN 'nan' WHEN ni > 0 THEN 'inf' END AS reason,
       CASE WHEN model_id IS NULL THEN round((rp - np * (np + 1) / 2) / (np * ng), 10) END AS auc
FROM v CROSS JOIN s2""")
def prediction_guard_bad(spark, sf_dir):
    ev = M.evaluate(_bad_predictions(spark, sf_dir), _labels(spark, sf_dir))
    return ev.select("model_id", "n_preds", "n_matched", "n_duplicate", "reason", F.round("auc", 10).alias("auc"))


@register("prediction_guard_single_class", "P11 A19", fx.with_views(
    "SELECT model_id, count(*) AS n_preds, 'single_class' AS reason, FALSE AS valid FROM predictions p JOIN labelled l ON p.key = l.key "
    "WHERE l.target = 1 GROUP BY model_id", "labelled", "predictions"))
def prediction_guard_single_class(spark, sf_dir):
    labels = _labels(spark, sf_dir).where(F.col("target") == 1)
    preds = fx.predictions(spark, sf_dir).join(labels.select("key"), "key", "left_semi")
    return M.evaluate(preds, labels).select("model_id", "n_preds", "reason", "valid")


_WEIGHTS = [("m1", 0.7), ("m2", 0.3)]


@register("ensemble_weighted", "M13 A21", fx.with_views(
    "SELECT key, round(sum(p1 * w) / sum(w), 10) AS p1 FROM (SELECT key, model_id, avg(p1) AS p1, CASE model_id WHEN 'm1' THEN 0.7::DOUBLE "
    "WHEN 'm2' THEN 0.3::DOUBLE END AS w FROM predictions GROUP BY key, model_id) t GROUP BY key HAVING count(*) = 2", "predictions"))
def ensemble_weighted(spark, sf_dir):
    from ..sources.tables import literal_table
    weights = literal_table(spark, _WEIGHTS, ["model_id", "weight"])
    return M.ensemble_mean(fx.predictions(spark, sf_dir), weights=weights).select("key", F.round("p1", 10).alias("p1"))


@register("ensemble_rejects", "M13 A21", fx.with_views(
    "SELECT key, count(DISTINCT model_id) AS n_models FROM predictions WHERE NOT (model_id = 'm2' AND key % 9 = 0) GROUP BY key "
    "HAVING count(DISTINCT model_id) <> 2", "predictions"))
def ensemble_rejects(spark, sf_dir):
    p = fx.predictions(spark, sf_dir).where(~((F.col("model_id") == "m2") & (F.col("key") % 9 == 0)))
    return M.ensemble_rejects(p)


@register("sequential_ids_text", "W5", fx.with_views(
    "SELECT customer_id, n_rows, row_number() OVER (ORDER BY customer_id) - 1 AS row_id FROM "
    "(SELECT customer_id, count(*) AS n_rows FROM labelled GROUP BY customer_id) t", "labelled"))
def sequential_ids_text(spark, sf_dir):
    names = fx.labelled(spark, sf_dir).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return R.row_index(names, "customer_id", "row_id")


@register("running_total_by_day", "W2 W5", fx.with_views(
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n, coalesce(sum(count(*)) OVER (ORDER BY CAST(ts AS DATE) ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING), 0)::BIGINT AS n_before FROM attempts GROUP BY 1", "attempts"))
def running_total_by_day(spark, sf_dir):
    days = fx.attempts(spark, sf_dir).groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return R.running(days, "day", "n", out="n_before")

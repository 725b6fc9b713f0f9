"""Registered encoder queries: fitted on the train split of ``labelled``, applied to all rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import encode as E
from ..session import scratch_path
from .registry import register
from .split_plans import SPLIT_CTES, labelled_split, stored_split
from ..sources import fixtures as fx


def _sql(select: str, extra: str = "") -> str:
    return fx.with_views("", "labelled").rstrip() + "," + SPLIT_CTES + extra + select


def _vocab_cte(col: str) -> str:
    return (f", voc_{col} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
            f"(SELECT DISTINCT coalesce({col}, '__nan__') AS v FROM assigned WHERE split = 'train') d)\n")


@register("label_encode", "M3 J2 F5 F6", _sql(
    "SELECT a.key, a.split, "
    "coalesce(p.code, (SELECT CAST(count(*) AS INTEGER) FROM voc_priority)) AS priority_code, "
    "coalesce(s.code, (SELECT CAST(count(*) AS INTEGER) FROM voc_segment)) AS segment_code "
    "FROM assigned a LEFT JOIN voc_priority p ON coalesce(a.priority, '__nan__') = p.v "
    "LEFT JOIN voc_segment s ON coalesce(a.segment, '__nan__') = s.v",
    _vocab_cte("priority") + _vocab_cte("segment")))
def label_encode(spark, sf_dir):
    sp = labelled_split(spark, sf_dir)
    cols = ["priority", "segment"]
    model = E.label_encoder(cols).fit(sp.where(F.col("split") == "train"))
    return E.apply_label_codes(model, sp, cols).select("key", "split", "priority_code", "segment_code")


@register("freq_encode", "M4 J1 A8 H4", _sql(
    "SELECT a.key, a.split, coalesce(f.freq, 0.0) AS stock_code_freq FROM assigned a LEFT JOIN fr f ON a.stock_code = f.v",
    ", fr AS (SELECT stock_code AS v, count(*) / (SELECT count(stock_code) FROM assigned WHERE split = 'train') AS freq "
    "FROM assigned WHERE split = 'train' AND stock_code IS NOT NULL GROUP BY stock_code)\n"))
def freq_encode(spark, sf_dir):
    sp = labelled_split(spark, sf_dir)
    enc = E.FrequencyEncoder(inputCols=["stock_code"], outputCols=["stock_code_freq"])
    model = enc.fit(sp.where(F.col("split") == "train"))
    return model.transform(sp).select("key", "split", "stock_code_freq")


_UNSEEN_COLS = ["priority", "segment", "stock_code", "customer_id", "order_group"]  # the last has values outside train
_GROUPED = "(SELECT *, concat('G', CAST(key % 5003 AS VARCHAR)) AS order_group FROM assigned)"


@register("unseen_categories", "J6", _sql(
    "SELECT o.\"column\", o.value, o.split, o.rows FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", coalesce({c}, '__nan__') AS value, split, count(*) AS rows FROM {_GROUPED} "
        f"WHERE split <> 'train' GROUP BY 2, 3" for c in _UNSEEN_COLS)
    + ") o WHERE NOT EXISTS (SELECT 1 FROM ("
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS \"column\", coalesce({c}, '__nan__') AS value FROM {_GROUPED} WHERE split = 'train'"
        for c in _UNSEEN_COLS)
    + ") k WHERE k.\"column\" = o.\"column\" AND k.value = o.value)"))
def unseen_categories(spark, sf_dir):
    sp = labelled_split(spark, sf_dir)
    return E.unseen_categories(sp.withColumn("order_group", F.concat(F.lit("G"), (F.col("key") % 5003).cast("string"))), _UNSEEN_COLS)


@register("median_impute", "M2 A10 F5", _sql(
    "SELECT key, split, round(coalesce(total_price, (SELECT median(total_price) FROM assigned WHERE split = 'train')), 6) "
    "AS total_price_filled FROM assigned"))
def median_impute(spark, sf_dir):
    sp = stored_split(spark, sf_dir)
    med = E.fit_medians(sp.where(F.col("split") == "train"), ["total_price"])
    return E.impute(sp, med, "_filled").select("key", "split", F.round("total_price_filled", 6).alias("total_price_filled"))


@register("standard_scale", "M5", _sql(
    "SELECT key, split, round((total_price - m.mt) / CASE WHEN m.st = 0 THEN 1 ELSE m.st END, 9) AS total_price_std, "
    "round((acct_bal - m.ma) / CASE WHEN m.sa = 0 THEN 1 ELSE m.sa END, 9) AS acct_bal_std FROM assigned CROSS JOIN "
    "(SELECT avg(total_price) AS mt, stddev_pop(total_price) AS st, avg(acct_bal) AS ma, stddev_pop(acct_bal) AS sa "
    "FROM assigned WHERE split = 'train') m"))
def standard_scale(spark, sf_dir):
    sp = labelled_split(spark, sf_dir)
    st = E.fit_standard(sp.where(F.col("split") == "train"), ["total_price", "acct_bal"])
    out = E.standardize(sp, st)
    return out.select("key", "split", F.round("total_price_std", 9).alias("total_price_std"),
                      F.round("acct_bal_std", 9).alias("acct_bal_std"))


@register("class_weights", "A22", _sql(
    "SELECT target, count(*) AS n_c, (SELECT count(*) FROM assigned WHERE split = 'train') / "
    "((SELECT count(DISTINCT target) FROM assigned WHERE split = 'train') * count(*)) AS weight "
    "FROM assigned WHERE split = 'train' GROUP BY target"))
def class_weights(spark, sf_dir):
    sp = labelled_split(spark, sf_dir)
    return E.class_weights(sp.where(F.col("split") == "train"))


@register("derived_features", "P5 P6 U3 P4 H1", fx.with_views(
    "SELECT key, total_price / (acct_bal + 1e-9) AS price_per_balance, total_price * total_price AS total_price_sq, "
    "acct_bal * acct_bal AS acct_bal_sq, CAST(nation_key AS FLOAT) AS nation_key_f FROM labelled", "labelled"))
def derived_features(spark, sf_dir):
    from ..operators.features import apply_hook, polynomial, ratio

    def build_features(ds):  # a user hook (H1): DataFrame in, DataFrame out, run once on all rows
        ds = ratio(ds, "total_price", "acct_bal", "price_per_balance")
        return polynomial(ds, ["total_price", "acct_bal"])

    df = apply_hook(fx.labelled(spark, sf_dir), build_features)
    return df.select("key", "price_per_balance", "total_price_sq", "acct_bal_sq",
                     F.col("nation_key").cast("float").alias("nation_key_f"))


@register("split_accessors", "M8 M3", _sql(
    "SELECT a.split AS part, count(*) AS rows, sum(coalesce(p.code, (SELECT count(*) FROM voc_priority)))::BIGINT AS code_sum, "
    "CAST(sum(a.target) AS BIGINT) AS positives FROM assigned a LEFT JOIN voc_priority p ON coalesce(a.priority, '__nan__') = p.v GROUP BY a.split",
    _vocab_cte("priority")))
def split_accessors(spark, sf_dir):
    """Train and val rows taken from the table after a transform fitted on train."""
    from ..operators import split as S
    sp = labelled_split(spark, sf_dir)
    out = E.apply_label_codes(E.label_encoder(["priority"]).fit(S.part(sp, "train")), sp, ["priority"])
    parts = [S.part(out, w).agg(F.lit(w).alias("part"), F.count(F.lit(1)).alias("rows"), F.sum("priority_code").cast("bigint").alias("code_sum"),
                                F.sum("target").cast("bigint").alias("positives")) for w in ("train", "val")]
    return parts[0].unionByName(parts[1])


@register("named_chain", "M7 M2 M4 M5 W4", fx.with_views("", "labelled").rstrip() + "," + SPLIT_CTES + """,
md AS (SELECT median(total_price) AS m FROM assigned WHERE split = 'train'),
filled AS (SELECT a.*, coalesce(total_price, (SELECT m FROM md)) AS filled FROM assigned a),
st AS (SELECT avg(filled) AS mu, stddev_samp(filled) AS sd FROM filled WHERE split = 'train'),
fr AS (SELECT stock_code AS v, CAST(count(*) AS DOUBLE) / (SELECT count(stock_code) FROM assigned WHERE split = 'train') AS f FROM assigned WHERE split = 'train' GROUP BY 1)
SELECT key, split, round((filled - mu) / sd, 6) AS price_scaled, round(coalesce(f, 0), 9) AS code_freq,
       'impute,scale' AS fitted_first, 'code' AS fitted_second, '' AS fitted_third, 'scale,code' AS fitted_fourth
FROM filled CROSS JOIN st LEFT JOIN fr ON stock_code = v""")
def named_chain(spark, sf_dir):
    """A stage is added to a fitted chain, the chain is fitted again unchanged, and a middle stage is replaced:
    each time only the changed stage and those behind it are fitted, and the values equal a plain computation."""
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from ..operators import chain as C
    sp = stored_split(spark, sf_dir)
    train = sp.where(F.col("split") == "train").drop("split")
    path = scratch_path(spark, f"chains/{uuid.uuid4().hex}")
    steps = C.NamedChain(path)
    steps.add("impute", E.MedianImputer(inputCols=["total_price"], outputCols=["filled"]))
    steps.add("assemble", VectorAssembler(inputCols=["filled"], outputCol="x"))
    steps.add("scale", StandardScaler(inputCol="x", outputCol="scaled", withMean=False, withStd=True))
    first = steps.fit(train)
    second = steps.add("code", E.FrequencyEncoder(inputCols=["stock_code"], outputCols=["code_freq"])).fit(train)
    again = C.NamedChain(path)  # another session: the fitted stages come from the folder
    for name, stage in steps.stages:
        again.add(name, stage)
    third = again.fit(train)
    last = again.replace("scale", StandardScaler(inputCol="x", outputCol="scaled", withMean=True, withStd=True)).fit(train)
    out = last.transform(sp).withColumn("z", vector_to_array("scaled")[0])
    names = {"fitted_first": first, "fitted_second": second, "fitted_third": third, "fitted_fourth": last}
    return out.select("key", "split", F.round("z", 6).alias("price_scaled"), F.round("code_freq", 9).alias("code_freq"),
                      *[F.lit(",".join(m.fitted)).alias(n) for n, m in names.items()])

"""Registered split queries on the ``labelled`` fixture."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import split as S
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import tables as TB
from .registry import register

SEED, TEST_SIZE = 42, 0.2


def labelled_split(spark, sf_dir):
    return S.stratified_split(fx.labelled(spark, sf_dir), "key", "target", TEST_SIZE, SEED)


def stored_split(spark, sf_dir):
    """The split table written once, for queries that read it several times: each pass over
    ``labelled_split`` joins and shuffles the source tables again."""
    sp = labelled_split(spark, sf_dir)
    path = scratch_path(spark, f"splits/{uuid.uuid4().hex}")
    TB.write_splits(sp, path)
    return spark.read.schema(sp.schema).parquet(path)


# SQL twin: a plain row_number in hash order against integer quotas.
SPLIT_CTES = f"""
cls AS (SELECT target, count(*) AS n_c FROM labelled GROUP BY target),
tot AS (SELECT sum(n_c) AS n, CAST(ceil(sum(n_c) * {TEST_SIZE}) AS BIGINT) AS n_val FROM cls),
q AS (SELECT c.target, c.n_c, (c.n_c * (t.n - t.n_val)) // t.n AS fl, (c.n_c * (t.n - t.n_val)) % t.n AS rem,
             t.n, t.n_val FROM cls c CROSS JOIN tot t),
q2 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, target) AS rr,
              (n - n_val) - sum(fl) OVER () AS left_over FROM q),
quota AS (SELECT target, n_c - (fl + CASE WHEN rr <= left_over THEN 1 ELSE 0 END) AS val_c FROM q2),
ranked AS (SELECT l.*, row_number() OVER (PARTITION BY l.target
                  ORDER BY md5(concat('{SEED}', ':', CAST(l.key AS VARCHAR))), l.key) AS rn FROM labelled l),
assigned AS (SELECT r.*, CASE WHEN r.rn <= q.val_c THEN 'val' ELSE 'train' END AS split
             FROM ranked r JOIN quota q ON r.target = q.target)
"""


def _split_sql(select: str) -> str:
    return fx.with_views("", "labelled").rstrip() + "," + SPLIT_CTES + select


@register("stratified_split_keys", "M1 S6", _split_sql("SELECT key, target, split FROM assigned"))
def stratified_split_keys(spark, sf_dir):
    return labelled_split(spark, sf_dir).select("key", "target", "split")


@register("split_counts", "A20 A11", _split_sql(
    "SELECT split, count(*) AS rows, CAST(count_if(target = 1) AS BIGINT) AS positives, CAST(count_if(target = 0) AS BIGINT) AS negatives, "
    "avg(CAST(target AS DOUBLE)) AS positive_rate, 8 AS n_columns FROM assigned GROUP BY split"))
def split_counts(spark, sf_dir):
    return S.split_counts(labelled_split(spark, sf_dir))


@register("split_partition_check", "U2", _split_sql(
    "SELECT (SELECT count(*) FROM labelled) AS n_full, "
    "(SELECT count(*) FROM assigned WHERE split = 'train') AS n_train, "
    "(SELECT count(*) FROM assigned WHERE split = 'val') AS n_val, "
    "(SELECT count(*) FROM (SELECT key FROM assigned WHERE split = 'train' INTERSECT SELECT key FROM assigned WHERE split = 'val') i) AS n_overlap, "
    "(SELECT count(*) FROM (SELECT key FROM labelled EXCEPT ALL SELECT key FROM assigned) e) AS n_missing, "
    "(SELECT count(*) FROM (SELECT key FROM assigned EXCEPT ALL SELECT key FROM labelled) x) AS n_extra"))
def split_partition_check(spark, sf_dir):
    full = fx.labelled(spark, sf_dir)
    return S.partition_check(full, labelled_split(spark, sf_dir), "key")


@register("val_rows", "J8 P1", _split_sql(
    "SELECT key, total_price, acct_bal, nation_key, priority, segment, stock_code, customer_id "
    "FROM labelled WHERE key IN (SELECT key FROM assigned WHERE split = 'val')"))
def val_rows(spark, sf_dir):
    full = fx.labelled(spark, sf_dir)
    import uuid
    from ..session import scratch_path
    path = scratch_path(spark, f"assignments/{uuid.uuid4().hex}")
    S.save_assignment(labelled_split(spark, sf_dir), "key", path)  # written once, read by every later job
    assignment = spark.read.parquet(path)
    return S.rows_in_split(full, assignment, "key", "val").drop("target")


@register("positive_rate_by_split", "A11 A19", _split_sql(
    "SELECT split, avg(CAST(target AS DOUBLE)) AS positive_rate, count(DISTINCT target) AS n_classes "
    "FROM assigned GROUP BY split"))
def positive_rate_by_split(spark, sf_dir):
    return labelled_split(spark, sf_dir).groupBy("split").agg(
        F.avg(F.col("target").cast("double")).alias("positive_rate"),
        F.count_distinct("target").alias("n_classes"))


# ---------------------------------------------------------------- bench-size variant (lineitem, composite key)

_BIG_KEY = fx.LABELLED_BIG_KEY
_BIG_HASH = ("md5(concat_ws(':', '42', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
             "CAST(CAST(l_extendedprice AS DECIMAL(38,10)) AS VARCHAR)))")
SPLIT_BIG_CTES = (SPLIT_CTES.replace("FROM labelled GROUP BY target", "FROM labelled_big GROUP BY target")
                  .replace("ORDER BY md5(concat('42', ':', CAST(l.key AS VARCHAR))), l.key",
                           "ORDER BY " + _BIG_HASH.replace("l_", "l.l_") + ", " + ", ".join("l." + k for k in _BIG_KEY))
                  .replace("FROM labelled l", "FROM labelled_big l"))


@register("stratified_split_big", "M1 S6", fx.with_views("", "labelled_big").rstrip() + "," + SPLIT_BIG_CTES
          + "SELECT " + ", ".join(_BIG_KEY) + ", target, split FROM assigned")
def stratified_split_big(spark, sf_dir):
    sp = S.stratified_split(fx.labelled_big(spark, sf_dir), _BIG_KEY, "target", TEST_SIZE, SEED)
    return sp.select(*_BIG_KEY, "target", "split")



@register("split_files_roundtrip", "S6 S4 S1", _split_sql(
    "SELECT split, count(*) AS rows, CAST(sum(target) AS BIGINT) AS positives FROM assigned GROUP BY split"))
def split_files_roundtrip(spark, sf_dir):
    import uuid
    from ..session import scratch_path
    from ..sources import tables as TB
    base = scratch_path(spark, f"splits/{uuid.uuid4().hex}")
    TB.write_splits(labelled_split(spark, sf_dir), base)
    ds = TB.load_dataset(spark, f"{base}/split=train", f"{base}/split=val")
    return ds.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum("target").cast("bigint").alias("positives"))


@register("feature_frame", "P1 P2 P3 P4 F2", fx.with_views(
    "SELECT key, CAST(total_price AS FLOAT) AS total_price, CAST(acct_bal AS FLOAT) AS acct_bal, "
    "CAST(nation_key AS FLOAT) AS nation_key, CAST(TRY_CAST(substr(stock_code, 2) AS DOUBLE) AS FLOAT) AS stock_num, "
    "'bogus_feature' AS missing FROM labelled", "labelled"))
def feature_frame(spark, sf_dir):
    from ..functions.scalar import to_double
    from ..operators import features as FE
    from ..operators import profile as P
    df = fx.labelled(spark, sf_dir)
    roles = P.roles(P.profile(df))
    df = FE.drop_columns(df, roles["id_like"] + ["target"])  # P3, P1
    df = df.withColumn("stock_num", to_double(F.substring("stock_code", 2, 10)))  # F2
    wanted = ["key", "total_price", "acct_bal", "nation_key", "stock_num", "bogus_feature"]
    sel, missing = FE.select_features(df, wanted)  # P2: the missing list is returned
    out = FE.as_float(sel, ["total_price", "acct_bal", "nation_key", "stock_num"])  # P4
    return out.withColumn("missing", F.lit(",".join(missing)))


# ---------------------------------------------------------------- sticky split over two increments

_FIRST = "key % 3 <> 0"
STICKY_CTES = f"""
c1 AS (SELECT target, count(*) AS n_c FROM labelled WHERE {_FIRST} GROUP BY target),
c2 AS (SELECT target, count(*) AS n_c FROM labelled GROUP BY target),
g1 AS (SELECT target, n_c, sum(n_c) OVER () AS n, CAST(ceil(sum(n_c) OVER () * {TEST_SIZE}) AS BIGINT) AS n_val FROM c1),
g2 AS (SELECT target, n_c, sum(n_c) OVER () AS n, CAST(ceil(sum(n_c) OVER () * {TEST_SIZE}) AS BIGINT) AS n_val FROM c2),
f1 AS (SELECT *, (n_c * (n - n_val)) // n AS fl, (n_c * (n - n_val)) % n AS rem FROM g1),
f2 AS (SELECT *, (n_c * (n - n_val)) // n AS fl, (n_c * (n - n_val)) % n AS rem FROM g2),
r1 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, target) AS rr, (n - n_val) - sum(fl) OVER () AS left_over FROM f1),
r2 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, target) AS rr, (n - n_val) - sum(fl) OVER () AS left_over FROM f2),
v1 AS (SELECT target, n_c - (fl + CASE WHEN rr <= left_over THEN 1 ELSE 0 END) AS val_c FROM r1),
v2 AS (SELECT r2.target, greatest(r2.n_c - (r2.fl + CASE WHEN r2.rr <= r2.left_over THEN 1 ELSE 0 END) - coalesce(v1.val_c, 0), 0) AS val_c
       FROM r2 LEFT JOIN v1 ON r2.target = v1.target),
ranked AS (SELECT l.key, l.target, CASE WHEN l.{_FIRST} THEN 1 ELSE 2 END AS increment, row_number() OVER (PARTITION BY l.target, l.{_FIRST}
           ORDER BY md5(concat('{SEED}', ':', CAST(l.key AS VARCHAR))), l.key) AS rn FROM labelled l),
assigned AS (SELECT r.key, r.target, r.increment, CASE WHEN r.rn <= CASE WHEN r.increment = 1 THEN v1.val_c ELSE v2.val_c END THEN 'val' ELSE 'train' END AS split
             FROM ranked r LEFT JOIN v1 ON r.target = v1.target LEFT JOIN v2 ON r.target = v2.target)
"""


@register("sticky_split_keys", "M1 J8 U2", fx.with_views("", "labelled").rstrip() + "," + STICKY_CTES
          + "SELECT key, target, split, split AS split_before FROM assigned WHERE increment = 1 "
            "UNION ALL SELECT key, target, split, NULL FROM assigned WHERE increment = 2")
def sticky_split_keys(spark, sf_dir):
    """Two increments, the second holding all rows of the first again: old keys keep their side, quotas stay exact."""
    import uuid
    from ..operators import sticky_split as K
    from ..session import scratch_path
    df = fx.labelled(spark, sf_dir)
    log = K.assignment_log(spark, scratch_path(spark, f"sticky/{uuid.uuid4().hex}"), df, ["key"], "target")
    K.assign(log, df.where(_FIRST), ["key"], "first")
    before = log.read().select(F.col("key").alias("__key"), F.col("split").alias("split_before"))
    K.assign(log, df, ["key"], "second")
    K.assign(log, df, ["key"], "second")  # run again
    now = K.with_split(df.select("key", "target"), log, ["key"])
    return now.join(before, F.col("key") == F.col("__key"), "left").drop("__key")

"""A column profile that grows: mergeable per-increment states instead of a new scan of everything.

``column_states`` turns one increment (a day, a file drop) into a few rows per column. States of any increments merge
without reading their data again:

* counts, nulls, zeros, min, max: exact, by sums and extremes;
* mean and standard deviation: from (count, mean, sum of squared deviations), merged with the shift of the means;
* distinct values of a non-numeric column: an HLL sketch (2^``LG_K`` registers, relative error about
  0.8 % at one standard deviation), and beside it, while the sketch estimate is at most ``EXACT_MAX`` (25 % above the larger
  role threshold, dozens of standard errors), the values themselves with their counts. The merged values give the exact
  distinct count and the exact top values, so every role is decided exactly: a column whose values are no
  longer kept is beyond both thresholds. Beyond ``EXACT_MAX`` the distinct count is the sketch's and says so;
* medians of numeric columns: a KLL sketch (rank error about 1.3 %).

Only those values are ever shuffled: an increment moves at most ``EXACT_MAX`` values per column (a column with more is
left out after the sketch pass), never one row per value of a text column. States live in a ``CommitLog``: an increment
that is profiled again changes nothing, and a compaction folds all states into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import finite, looks_like_id, qcol
from ..sources.commits import CommitLog
from .profile import CATEGORICAL_MAX_DISTINCT, ID_LIKE_MIN_DISTINCT, _kind, feature_columns

LG_K = 14
EXACT_MAX = ID_LIKE_MIN_DISTINCT * 5 // 4
KLL_K = 200
STATE = ("section string, column string, position int, kind string, dtype string, n long, nn long, mean double, m2 double, min double, "
         "max double, zeros long, hll binary, kll binary, exact boolean, value string, count long")


def state_log(spark, path: str) -> CommitLog:
    return CommitLog(spark, path, STATE)


def _conform(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    fields = [f.strip().split(" ") for f in STATE.split(",")]
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast({"long": "bigint"}.get(t, t)).alias(n) for n, t in fields])


def column_states(df: DataFrame, target: str | None = "target", exclude: tuple[str, ...] = (), exact_max: int = EXACT_MAX) -> DataFrame:
    """The state rows of one increment: ``section`` ``column`` (one per column) and ``value`` (kept values with their counts).

    Two scans: one aggregation of everything but the kept values, and one of the columns whose sketch says that their
    values are few.
    """
    spark = df.sparkSession
    cols = feature_columns(df, target, exclude)
    kinds = {f.name: (_kind(f.dataType), f.dataType.simpleString()) for f in df.schema.fields if f.name in cols}
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        x = qcol(c)
        if kinds[c][0] == "numeric":
            v = x.cast("double")
            parts = [F.count(x).alias("nn"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(x)).alias("m2"), F.min(v).alias("min"),
                     F.max(v).alias("max"), F.count_if(v == 0).alias("zeros"), F.lit(None).cast("binary").alias("hll"),
                     F.kll_sketch_agg_double(finite(v), F.lit(KLL_K)).alias("kll")]
        else:
            none = [F.lit(None).cast("double").alias(k) for k in ("mean", "m2", "min", "max")]
            parts = [F.count(x).alias("nn"), *none, F.lit(None).cast("bigint").alias("zeros"),
                     F.hll_sketch_agg(x.cast("string"), LG_K).alias("hll"), F.lit(None).cast("binary").alias("kll")]
        aggs.append(F.struct(*parts).alias(f"s{i}"))
    if not cols:
        return spark.createDataFrame([], STATE)
    row = df.agg(*aggs)
    stats = row.select(F.inline(F.array(*[F.struct(
        F.lit("column").alias("section"), F.lit(c).alias("column"), F.lit(i).alias("position"), F.lit(kinds[c][0]).alias("kind"),
        F.lit(kinds[c][1]).alias("dtype"), F.col("n"), *[F.col(f"s{i}")[k].alias(k) for k in ("nn", "mean", "m2", "min", "max", "zeros", "hll", "kll")])
        for i, c in enumerate(cols)]))).checkpoint()  # one row per column
    few = [r["column"] for r in stats.where("hll is not null").select("column", F.hll_sketch_estimate("hll").alias("e")).collect()
           if r["e"] <= exact_max]
    stats = stats.withColumn("exact", (F.col("kind") == "numeric") | F.col("column").isin(few))
    if not few:
        return _conform(stats)
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("value")) for c in few])))
    values = pairs.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return _conform(stats).unionByName(_conform(values.withColumn("section", F.lit("value"))))


def merged(states: DataFrame, exact_max: int = EXACT_MAX) -> DataFrame:
    """All states as the state of the union of their increments (a few rows per column)."""
    s = states.where("section = 'column'")
    # the shift of the means: sum of squares around the merged mean
    mean = F.try_divide(F.sum(F.col("nn") * F.col("mean")), F.sum(F.when(F.col("mean").isNotNull(), F.col("nn"))))
    first = s.groupBy("column").agg(mean.alias("all_mean"))
    both = s.join(F.broadcast(first), "column")  # one row per column
    gap = F.col("mean") - F.col("all_mean")
    stats = both.groupBy("column").agg(
        F.min("position").alias("position"), F.first("kind").alias("kind"), F.first("dtype").alias("dtype"), F.sum("n").alias("n"), F.sum("nn").alias("nn"),
        F.first("all_mean").alias("mean"), F.sum(F.col("m2") + F.col("nn") * gap * gap).alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum("zeros").alias("zeros"), F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"), F.min("exact").alias("exact"))
    stats = stats.withColumn("hll", F.when(F.col("kind") != "numeric", F.col("hll"))).withColumn("kll", F.when(F.col("kind") == "numeric", F.col("kll")))
    # columns that are small in every increment: their values, while the union is small, too
    kept = states.where("section = 'value'").join(F.broadcast(stats.where("exact").select("column")), "column", "left_semi")
    values = kept.groupBy("column", "value").agg(F.sum("count").alias("count"))
    over = values.groupBy("column").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > exact_max).select("column").withColumn("over", F.lit(True))
    stats = stats.join(F.broadcast(over), "column", "left").withColumn("exact", F.col("exact") & F.col("over").isNull()).drop("over")
    values = values.join(F.broadcast(over), "column", "left_anti")
    return _conform(stats.withColumn("section", F.lit("column"))).unionByName(_conform(values.withColumn("section", F.lit("value"))))


def profile_of(states: DataFrame, round_stats: bool = True, exact_max: int = EXACT_MAX) -> DataFrame:
    """The profile of all increments: the columns of ``profile.profile``, plus ``n_unique_exact`` and ``median``.

    ``n_unique`` is the sketch's estimate where ``n_unique_exact`` is false.
    """
    m = merged(states, exact_max).checkpoint()
    distinct = m.where("section = 'value'").groupBy("column").agg(F.count(F.lit(1)).alias("d"))
    s = m.where("section = 'column'").select("column", "position", "kind", "dtype", "n", "nn", "mean", "m2", "min", "max", "zeros", "hll", "kll", "exact")
    s = s.join(F.broadcast(distinct), "column", "left")
    text = F.col("kind") != "numeric"
    nd = F.when(text, F.when(F.col("exact"), F.coalesce("d", F.lit(0))).otherwise(F.hll_sketch_estimate("hll")))
    idw = F.lit(False)
    for r in s.select("column").collect():  # names only, one per column
        if looks_like_id(r["column"]):
            idw = idw | (F.col("column") == r["column"])
    # a column whose values are not kept is beyond both thresholds
    many, few = ~F.col("exact") | (nd > ID_LIKE_MIN_DISTINCT), F.col("exact") & (nd <= CATEGORICAL_MAX_DISTINCT)
    role = (F.when(~text, "numeric").when((F.col("kind") == "string") & idw & many, "id_like")
            .when((F.col("kind") == "string") & few, "categorical").otherwise("high_cardinality"))
    std = F.when(F.col("nn") > 1, F.sqrt(F.col("m2") / (F.col("nn") - 1)))

    def stat(x: Column) -> Column:
        return F.round(finite(x), 4) if round_stats else finite(x)

    nulls = F.col("n") - F.col("nn")
    pct = F.when(F.col("n") > 0, nulls / F.col("n") * 100)
    zero = F.when((F.col("n") > 0) & ~text, F.col("zeros") / F.col("n") * 100)
    median = F.when(~text & (F.col("nn") > 0), F.kll_sketch_get_quantile_double("kll", F.lit(0.5)))
    return s.select("column", "position", role.alias("role"), "dtype", nd.cast("bigint").alias("n_unique"), stat(F.col("mean")).alias("mean"),
                    stat(std).alias("std"), stat(F.col("min")).alias("min"), stat(F.col("max")).alias("max"),
                    (F.round(pct, 2) if round_stats else pct).alias("null_pct"), (F.round(zero, 2) if round_stats else zero).alias("zeros_pct"),
                    nulls.alias("null_count"), (~text | F.col("exact")).alias("n_unique_exact"), median.alias("median"))


def top_values_of(states: DataFrame, k: int = 5, exact_max: int = EXACT_MAX) -> DataFrame:
    """A5 from states: the k most frequent values of every categorical column, exact; ties by value."""
    values = merged(states, exact_max).where("section = 'value'").select("column", "value", "count")
    small = values.groupBy("column").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") <= CATEGORICAL_MAX_DISTINCT).select("column")
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value"))  # at most 50 rows per column
    return values.join(F.broadcast(small), "column", "left_semi").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def add_increment(log: CommitLog, df: DataFrame, increment: str, **options) -> bool:
    """Profile one increment into the log; ``False`` if it was profiled before."""
    return increment not in log.batches() and log.append(column_states(df, **options), increment)

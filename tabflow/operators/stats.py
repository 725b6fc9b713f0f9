"""Exact order statistics without a single-task group (A10, M2 fitting).

Spark's exact ``median``/``percentile`` keeps every distinct value of a group in
one aggregation buffer; on a global (ungrouped) median that is the whole column
in one task. Here each column is cut into value-range buckets, bucket counts
locate the range that holds the middle ranks, that range alone is cut again, and
only the distinct values of the range found last (about 1 / N_BUCKETS^2 of the
rows) are ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import qcol
from ..sources.tables import literal_table
from .ranking import default_buckets, quantile_splits, with_buckets

LEVELS = 2


def exact_medians(df: DataFrame, cols: list[str], n_buckets: int | None = None) -> DataFrame:
    """Interpolated median per column (nulls ignored), ``(column, median)``; equals SQL ``median``."""
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column string, median double")
    n_buckets = n_buckets or default_buckets(df)
    # positional names: user column names may contain dots or spaces
    v = [f"__c{i}" for i in range(len(cols))]
    wide = df.select(*[F.nanvl(qcol(c).cast("double"), F.lit(None)).alias(x) for c, x in zip(cols, v)])
    # per column: rows before the open range and the wanted ranks (0-based)
    before, lo, hi = {}, {}, {}
    for level in range(LEVELS):
        splits = quantile_splits(wide, v, n_buckets)
        b = [f"__b{i}" for i in range(len(cols))]
        staged = with_buckets(wide, v, b, n_buckets)
        longf = staged.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.when(F.col(x).isNotNull(), F.col(y)).alias("bucket"))
                                                 for i, (x, y) in enumerate(zip(v, b))]))).where(F.col("bucket").isNotNull())
        # at most n_buckets rows per column reach the driver
        counts: dict[int, dict[int, int]] = {}
        for r in longf.groupBy("i", "bucket").agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["i"], {})[r["bucket"]] = r["n"]
        keep = []
        for i, x in enumerate(v):
            got = sorted(counts.get(i, {}).items())
            if not level:
                n = sum(c for _, c in got)
                before[i], lo[i], hi[i] = 0, (n - 1) // 2, n // 2
            at, first, last = before[i], None, None
            for bucket, c in got:
                if first is None and lo[i] < at + c:
                    first, start = bucket, at
                at += c
                if first is not None and hi[i] < at:
                    last = bucket
                    break
            if first is None:
                keep.append(F.lit(None).cast("double").alias(x))
                continue
            before[i] = start
            inside = (F.col(x) >= F.lit(splits[i][first])) & (F.col(x) < F.lit(splits[i][last + 1]))
            if splits[i][last + 1] == float("inf"):
                inside = F.col(x) >= F.lit(splits[i][first])
            keep.append(F.when(inside, F.col(x)).alias(x))
        wide = wide.select(*keep)
    ranks = [(i, before[i], lo[i], hi[i]) for i in range(len(cols))]
    table = literal_table(spark, ranks, ["i", "before", "lo", "hi"])
    cand = wide.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(x).alias("value")) for i, x in enumerate(v)])))
    cand = (cand.where(F.col("value").isNotNull()).groupBy("i", "value").agg(F.count(F.lit(1)).alias("cnt"))
            .join(F.broadcast(table), "i"))  # one row per column
    w = Window.partitionBy("i").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    cand = cand.withColumn("start", F.col("before") + F.coalesce(F.sum("cnt").over(w), F.lit(0)))
    covers = lambda r: (F.col(r) >= F.col("start")) & (F.col(r) < F.col("start") + F.col("cnt"))
    picked = cand.groupBy("i").agg(F.max(F.when(covers("lo"), F.col("value"))).alias("a"),
                                   F.max(F.when(covers("hi"), F.col("value"))).alias("b"))
    med = picked.select("i", (F.col("a") + (F.col("b") - F.col("a")) * F.lit(0.5)).alias("median"))
    # every requested column gets a row (null median for an all-null column)
    names = literal_table(spark, list(enumerate(cols)), ["i", "column"])
    return names.join(F.broadcast(med), "i", "left").select("column", "median")

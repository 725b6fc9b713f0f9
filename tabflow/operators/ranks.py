"""W4 as a chain stage: ranks fitted on the training rows, looked up for any split.

``ranking.average_rank`` ranks one table by itself. Here ``fit`` keeps the training values with their counts, cut into
value ranges, and ``transform`` places any value among them: ``(rows below + (rows equal + 1) / 2) / n``, the average-tie
rank for values that training holds and a place half a row above the rows below for those it does not.

The lookup is a sorted merge inside value ranges: the distinct values of the table join the training values of their
range, a running count inside the range gives the rows below, and the range's offset (at most ``N_BUCKETS`` numbers, fitted)
the rest. Values beyond the training extremes need no order and are one value each, so a table that has drifted
out of the training range does not crowd the last range. ``transform`` runs no job. Null and NaN have no rank.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import fresh, qcol
from .ranking import N_BUCKETS, quantile_splits

INF = float("inf")


class RankTransform(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the values and counts of the input columns."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "RankTransformModel":
        cols = self.getInputCols()
        longf = dataset.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), qcol(c).cast("double").alias("v")) for i, c in enumerate(cols)])))
        # one row per column and distinct value, fitted state
        counts = longf.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("i", "v").agg(F.count(F.lit(1)).alias("cnt")).checkpoint()
        wide = counts.select(*[F.when(F.col("i") == i, F.col("v")).alias(f"q{i}") for i in range(len(cols))])
        splits = quantile_splits(wide, wide.columns, N_BUCKETS)
        sums = {}
        for i, s in enumerate(splits):  # one small grouping per column: its value ranges
            ranged = Bucketizer(splits=s, inputCol="v", outputCol="b").transform(counts.where(F.col("i") == i))
            sums |= {(i, int(r["b"])): r["n"] for r in ranged.groupBy("b").agg(F.sum("cnt").alias("n")).collect()}
        ends = {r["i"]: (r["lo"], r["hi"]) for r in counts.groupBy("i").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
        offsets, sizes = [], []
        for i, s in enumerate(splits):
            at, mine = 0, []
            for b in range(len(s) - 1):
                mine.append(float(at))
                at += sums.get((i, b), 0)
            offsets.append(mine)
            sizes.append(float(at))
        m = RankTransformModel(counts)
        lo_hi = [list(ends.get(i, (0.0, 0.0))) for i in range(len(cols))]
        m._set(inputCols=cols, outputCols=self.getOutputCols(), splits=splits, offsets=offsets, sizes=sizes, ends=lo_hi)
        return m


class _RankModelWriter(MLWriter):
    def __init__(self, instance: "RankTransformModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.counts.write.mode("overwrite").parquet(f"{path}/counts")


class _RankModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> "RankTransformModel":
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        m = self.cls(self.sparkSession.read.schema("i int, v double, cnt long").parquet(f"{path}/counts"))
        DefaultParamsReader.getAndSetParams(m, meta)
        return m


class RankTransformModel(Model, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    """Training values with their counts (a table), the value ranges and their offsets (parameters)."""

    splits = Param(Params._dummy(), "splits", "value ranges per column", typeConverter=TypeConverters.identity)
    offsets = Param(Params._dummy(), "offsets", "rows below each range per column", typeConverter=TypeConverters.identity)
    sizes = Param(Params._dummy(), "sizes", "training rows per column", typeConverter=TypeConverters.toListFloat)
    ends = Param(Params._dummy(), "ends", "smallest and largest training value per column", typeConverter=TypeConverters.identity)

    def __init__(self, counts: DataFrame | None = None):
        super().__init__()
        self.counts = counts

    def write(self) -> MLWriter:
        return _RankModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _RankModelReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        get = self.getOrDefault
        for i, (c, o) in enumerate(zip(self.getInputCols(), self.getOutputCols())):
            n, (lo, hi), splits = get("sizes")[i], get("ends")[i], [float(x) for x in get("splits")[i]]
            v = qcol(c).cast("double")
            v = F.when(v.isNull() | F.isnan(v), F.lit(None).cast("double")).when(v < lo, F.lit(-INF)).when(v > hi, F.lit(INF)).otherwise(v)
            if not n:
                out = out.withColumn(o, F.lit(None).cast("double"))
                continue
            at, nk = fresh(out, "rank_value"), fresh(out, "rank_null")
            salt = 1 + F.pmod(F.xxhash64(*[qcol(x) for x in out.columns]), F.lit(1 << 20))  # nulls match nothing and spread
            staged = out.withColumn(at, v).withColumn(nk, F.when(qcol(at).isNull(), salt).otherwise(F.lit(0)))
            mine = self.counts.where(F.col("i") == i).select(F.col("v").alias("__v"), F.col("cnt").alias("__c"))
            asked = staged.where(qcol(at).isNotNull()).select(qcol(at).alias("__v"), F.lit(0).cast("bigint").alias("__c"))
            both = mine.unionByName(asked).groupBy("__v").agg(F.sum("__c").alias("__c"))
            both = Bucketizer(splits=splits, inputCol="__v", outputCol="__b").transform(both)
            w = Window.partitionBy("__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
            off = F.element_at(F.array(*[F.lit(float(x)) for x in get("offsets")[i]]), F.col("__b").cast("int") + 1)
            below = off + F.coalesce(F.sum("__c").over(w), F.lit(0))
            ranks = both.select(F.lit(0).cast("bigint").alias("__z"), F.col("__v"), ((below + (F.col("__c") + 1) / F.lit(2.0)) / F.lit(n)).alias("__r"))
            joined = staged.join(ranks, (F.col(nk) == F.col("__z")) & (qcol(at) == F.col("__v")), "left")
            out = joined.withColumn(o, F.col("__r")).drop(at, nk, "__z", "__v", "__r")
        return out

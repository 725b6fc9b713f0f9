"""Encoders fitted on training rows and applied to every split.

Fitted state is a table of one row per category, per column or per class.
Lookups are left joins. Tables of one row per column or class are hinted as broadcast, and so is a
vocabulary that the fit counted at ``BROADCAST_ROWS`` rows or fewer; a larger one is joined as Spark
picks from its size in bytes, and AQE splits a hot value's partition.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import fresh, qcol
from .stats import exact_medians

NAN_TOKEN = "__nan__"
BROADCAST_ROWS = 100_000  # vocabulary rows up to which a lookup is broadcast (counted at fit)


# ---------------------------------------------------------------- label codes

def label_encoder(cols: list[str], suffix: str = "_code") -> Pipeline:
    """M3: classes sorted ascending, code = index; null is the class ``__nan__``; unseen -> number of classes."""
    filled = ", ".join(f"coalesce(CAST(`{c}` AS STRING), '{NAN_TOKEN}') AS `{c}__s`" for c in cols)
    fill = SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")
    idx = StringIndexer(inputCols=[f"{c}__s" for c in cols], outputCols=[f"{c}__i" for c in cols],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    cast = ", ".join(f"CAST(`{c}__i` AS INT) AS `{c}{suffix}`" for c in cols)
    keep = SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__")
    return Pipeline(stages=[fill, idx, keep])


def apply_label_codes(model: PipelineModel, df: DataFrame, cols: list[str]) -> DataFrame:
    out = model.transform(df)
    return out.drop(*[f"{c}__s" for c in cols], *[f"{c}__i" for c in cols])


# ---------------------------------------------------------------- frequency encoding

class _FreqParams(HasInputCols, HasOutputCols):
    denominator = Param(Params._dummy(), "denominator", "'non_null' (A8) or 'all' rows (A9)",
                        typeConverter=TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "fitted: vocabulary rows per column", typeConverter=TypeConverters.toListInt)


class FrequencyEncoder(Estimator, _FreqParams, DefaultParamsReadable, DefaultParamsWritable):
    """M4: replace a category by its relative frequency among training rows; unseen and null -> 0.0."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, denominator="non_null"):
        super().__init__()
        self._setDefault(denominator="non_null")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FrequencyEncoderModel":
        cols = self.getInputCols()
        longf = dataset.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("value")) for c in cols])))
        counts = longf.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
        if self.getOrDefault("denominator") == "all":
            denom = counts.groupBy("column").agg(F.sum("cnt").alias("den"))
        else:
            denom = counts.where(F.col("value").isNotNull()).groupBy("column").agg(F.sum("cnt").alias("den"))
        vocab = (counts.where(F.col("value").isNotNull()).join(F.broadcast(denom), "column")
                 .select("column", "value", (F.col("cnt") / F.col("den")).alias("freq")))
        # the vocabulary is fitted state: write it once to the shared checkpoint folder
        vocab = vocab.checkpoint()
        n = {r["column"]: r["n"] for r in vocab.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
        m = FrequencyEncoderModel(vocab)
        m._set(inputCols=cols, outputCols=self.getOutputCols(), sizes=[n.get(c, 0) for c in cols])
        return m


class _FreqModelWriter(MLWriter):
    def __init__(self, instance: "FrequencyEncoderModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.vocab.write.mode("overwrite").parquet(f"{path}/vocab")


class _FreqModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> "FrequencyEncoderModel":
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        m = self.cls(self.sparkSession.read.parquet(f"{path}/vocab"))
        DefaultParamsReader.getAndSetParams(m, meta)
        return m


class FrequencyEncoderModel(Model, _FreqParams, MLWritable, MLReadable):
    """Saved with the chain (params as metadata, vocabulary as parquet)."""

    def __init__(self, vocab: DataFrame | None = None):
        super().__init__()
        self.vocab = vocab

    def write(self) -> MLWriter:
        return _FreqModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FreqModelReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        sizes = self.getOrDefault("sizes") if self.isSet("sizes") else [BROADCAST_ROWS + 1] * len(self.getInputCols())
        for c, o, n in zip(self.getInputCols(), self.getOutputCols(), sizes):
            if n <= BROADCAST_ROWS:  # a vocabulary of known, small size: a lookup in each task, no shuffle of the rows
                k, fr = fresh(out, "vocab_value"), fresh(out, "vocab_freq")
                v = self.vocab.where(F.col("column") == c).select(F.col("value").alias(k), F.col("freq").alias(fr))
                joined = out.join(F.broadcast(v), qcol(c).cast("string") == F.col(k), "left")
                out = joined.withColumn(o, F.coalesce(F.col(fr), F.lit(0.0))).drop(k, fr)
                continue
            # an equi-join whose strategy Spark picks by the vocabulary's size in bytes. A null value gets a
            # non-zero flag that matches nothing, hashed from the row: deterministic, and spread over partitions
            k, nk = fresh(out, "vocab_value"), fresh(out, "vocab_null")
            salt = 1 + F.pmod(F.xxhash64(*[qcol(x) for x in out.columns]), F.lit(1 << 20))
            flagged = out.withColumn(nk, F.when(qcol(c).isNull(), salt).otherwise(F.lit(0)))
            v = self.vocab.where(F.col("column") == c).select(F.lit(0).cast("long").alias("__zero"), F.col("value").alias(k), F.col("freq").alias("__freq"))
            joined = flagged.join(v, (F.col(nk) == F.col("__zero")) & (qcol(c).cast("string") == F.col(k)), "left")
            out = joined.withColumn(o, F.coalesce(F.col("__freq"), F.lit(0.0))).drop(k, nk, "__zero", "__freq")
        return out


# ---------------------------------------------------------------- unseen categories

def unseen_categories(df: DataFrame, cols: list[str], split_col: str = "split", fit_split: str = "train") -> DataFrame:
    """Values outside the training vocabulary, with the number of rows per split, ``(column, value, split, rows)``."""
    longf = df.select(split_col, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(qcol(c).cast("string"), F.lit(NAN_TOKEN)).alias("value"))
        for c in cols])))
    known = longf.where(F.col(split_col) == fit_split).select("column", "value").distinct()
    other = (longf.where(F.col(split_col) != fit_split)
             .groupBy("column", "value", split_col).agg(F.count(F.lit(1)).alias("rows")))
    return other.join(known, ["column", "value"], "left_anti")


# ---------------------------------------------------------------- imputation (M2)

def fit_medians(train: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Train medians, exact and interpolated (one small collect: one number per column)."""
    got = {r["column"]: r["median"] for r in exact_medians(train, cols).collect()}
    return {c: got.get(c) for c in cols}


class _MedianParams(HasInputCols, HasOutputCols):
    medians = Param(Params._dummy(), "medians", "fitted train medians (NaN: the column had no value)",
                    typeConverter=TypeConverters.toListFloat)


class MedianImputer(Estimator, _MedianParams, DefaultParamsReadable, DefaultParamsWritable):
    """M2 as a chain stage: exact interpolated train medians (not the approximate ``Imputer``)."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MedianImputerModel":
        vals = fit_medians(dataset, self.getInputCols())
        m = MedianImputerModel()
        m._set(inputCols=self.getInputCols(), outputCols=self.getOutputCols(),
               medians=[float("nan") if vals[c] is None else float(vals[c]) for c in self.getInputCols()])
        return m


class MedianImputerModel(Model, _MedianParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        meds = self.getOrDefault("medians")
        fill = {c: (None if v != v else v) for c, v in zip(self.getInputCols(), meds)}
        out = impute(dataset.withColumns({o: F.col(c) for c, o in zip(self.getInputCols(), self.getOutputCols())}),
                     {o: fill[c] for c, o in zip(self.getInputCols(), self.getOutputCols())})
        return out


def impute(df: DataFrame, values: dict[str, float | None], suffix: str = "") -> DataFrame:
    """Fill nulls with the fitted constants (M2 apply step; F5)."""
    return df.withColumns({f"{c}{suffix}": F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double"))
                           for c, v in values.items()})


# ---------------------------------------------------------------- scaling (M5)

def fit_standard(train: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population std per column (one aggregation), as the reference's scaler uses."""
    row = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def standardize(df: DataFrame, stats: dict[str, tuple[float | None, float | None]], suffix: str = "_std") -> DataFrame:
    """(x - mean) / std; a zero std leaves the centred value (scale 1), as the reference's scaler does."""
    out = {}
    for c, (m, s) in stats.items():
        scale = s if s not in (None, 0.0) else 1.0
        out[f"{c}{suffix}"] = (F.col(c).cast("double") - F.lit(m)) / F.lit(scale)
    return df.withColumns(out)


# ---------------------------------------------------------------- class weights

def class_weights(train: DataFrame, target: str = "target") -> DataFrame:
    """Balanced weights n / (k * n_c), one row per class."""
    counts = train.groupBy(target).agg(F.count(F.lit(1)).alias("n_c"))
    n = train.select(F.count(F.lit(1)).cast("double")).scalar()
    k = counts.select(F.count(F.lit(1)).cast("double")).scalar()
    return counts.select(target, "n_c", (n / (k * F.col("n_c"))).alias("weight"))


def with_class_weights(df: DataFrame, weights: DataFrame, target: str = "target", out: str = "weight") -> DataFrame:
    # one row per class: a bounded broadcast
    return df.join(F.broadcast(weights.select(target, F.col("weight").alias(out))), target, "left")

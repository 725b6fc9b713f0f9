"""Scans and sinks.

Every read goes through ``read_table`` so that float NaN becomes null at load:
in Spark NaN is an ordinary (largest) value that poisons ``avg``/``max``/
``median``, while the reference's pandas treats NaN as missing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import qcol
from .commits import CommitLog, publish

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_FLOATS = (T.FloatType, T.DoubleType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every float column (one projection, stays in codegen)."""
    cols: list[Column] = []
    changed = False
    for f in df.schema.fields:
        if isinstance(f.dataType, _FLOATS):
            cols.append(F.nanvl(qcol(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
            changed = True
        else:
            cols.append(qcol(f.name))
    return df.select(*cols) if changed else df


def literal_table(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small constant table as literals (a local scan in the plan, no Python-side RDD)."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).alias(n) for n in names])
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])))


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one parquet table of a scale-factor folder; prune to ``columns`` at the scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return nan_to_null(df)


def read_labelled(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """A labelled table from parquet or CSV (header). Infer a CSV schema once, then pass it."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("inferSchema", schema is None).csv(path)
    else:
        df = reader.format(fmt).load(path)
    return nan_to_null(df)


def detect_target(df: DataFrame) -> str:
    """``target`` if present, else the last column (metadata only)."""
    return "target" if "target" in df.columns else df.columns[-1]


def require_unique_key(df: DataFrame, key: list[str]) -> None:
    """Keyed alignment replaces positional alignment: refuse duplicate keys (one small agg)."""
    dup = df.groupBy(*key).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"key {key} is not unique")


def load_dataset(spark: SparkSession, train: str, val: str, test: str | None = None, fmt: str = "parquet",
                 schema: T.StructType | str | None = None) -> DataFrame:
    """Train + val (+ test) as one frame with a ``split`` column."""
    parts = [read_labelled(spark, train, fmt, schema).withColumn("split", F.lit("train")),
             read_labelled(spark, val, fmt, schema).withColumn("split", F.lit("val"))]
    if test:
        parts.append(read_labelled(spark, test, fmt, schema).withColumn("split", F.lit("test")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write_splits(df: DataFrame, path: str) -> bool:
    """Write the split-tagged table once; a complete output is kept, one that was never finished is replaced."""
    return publish(df, path, ("split",))


def write_predictions(preds: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Predictions as parquet ``(key, model_id, p1)``, partitioned by model."""
    preds.write.mode(mode).partitionBy("model_id").parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """S8 scan. NaN is kept as NaN here: the AUC guards must see it."""
    return spark.read.parquet(path)


def write_submission(test: DataFrame, preds: DataFrame, key: str, path: str) -> None:
    """``id,target`` CSV; one row per test row (left join keeps rows without a score)."""
    (test.select(key).join(preds.select(key, "p1"), key, "left")
     .select(F.col(key).alias("id"), F.col("p1").alias("target"))
     .write.mode("overwrite").option("header", True).csv(path))


ATTEMPT_SCHEMA = T.StructType([
    T.StructField("attempt_seq", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("agent_id", T.IntegerType()),
    T.StructField("round", T.IntegerType()),
    T.StructField("campaign", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("approach_description", T.StringType()),
    T.StructField("agent_analysis", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("cost_usd", T.DoubleType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
])

USAGE_SCHEMA = T.StructType([
    T.StructField("call_seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("model", T.StringType()),
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
])

RUN_META_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("agent_id", T.IntegerType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("error", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("duration_sec", T.DoubleType()),
])


def append_log(df: DataFrame, path: str, schema: T.StructType | None = None, batch: str | None = None) -> bool:
    """Append rows to an attempts or usage log (no read-modify-write, no lost updates).

    With a ``batch`` id the log is a ``CommitLog``: a batch that is there already (a job run again, a second
    writer) changes nothing. Without one, rows go to a plain folder and every call adds them.
    """
    if batch is not None:
        return CommitLog(df.sparkSession, path, schema or df.schema).append(df, batch)
    df.write.mode("append").parquet(path)
    return True


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S11/S12 scan: every committed batch once (or all rows of a plain folder)."""
    log = CommitLog(spark, path, schema)
    return log.read() if log.batches() else spark.read.schema(schema).parquet(path)


def write_run_meta(runs: DataFrame, runs_dir: str) -> None:
    """One folder per run id holding that run's JSON document."""
    (runs.withColumn("run", F.col("run_id")).repartition("run").write.mode("append").partitionBy("run").json(runs_dir))


def read_run_meta(spark: SparkSession, runs_dir: str, pattern: str = "*/*.json", multiline: bool = True) -> DataFrame:
    """Run metadata JSON (one document per run folder); the two duration spellings are merged."""
    df = (spark.read.schema(RUN_META_SCHEMA).option("multiLine", multiline)
          .json(f"{runs_dir.rstrip('/')}/{pattern}"))
    return (df.withColumn("duration_seconds", F.coalesce("duration_seconds", "duration_sec"))
              .drop("duration_sec"))

"""ST1: the usage ledger maintained call by call as a streaming daily total.

``readStream`` over the call table (one file or a folder of files, declared schema, NaN
made null as in the batch scan) -> broadcast price lookup (stream-static join) ->
``groupBy(day)`` with the same exact-money aggregates as the batch ``ledger.daily_usage``.

Every call counts, however late it arrives: there is no dropping watermark. The state is one
row per calendar day, so it does not need one.

The sink is a ``CommitLog`` in the shared checkpoint folder written by ``foreachBatch`` in update
mode: every micro-batch appends the days it changed under its own batch id. A replayed batch (after a
lost executor or driver restart) is there already and changes nothing; readers take, per day, the
row of the highest batch id. Every ``compact_every`` batches the rows before are folded to one per day,
so a stream of any age has a bounded number of folders.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import day_string
from ..operators.ledger import with_cost
from ..session import scratch_path
from ..sources.commits import CommitLog
from ..sources.fixtures import usage_from_events
from ..sources.tables import nan_to_null

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
TOTALS_SCHEMA = ("day string, spent_micro decimal(38,6), calls bigint, input_tokens bigint, output_tokens bigint, batch_id bigint")


def events_stream(spark: SparkSession, path: str, max_files: int = 1, schema: T.StructType = EVENTS_SCHEMA) -> DataFrame:
    """Streaming scan of a call table: ``path`` is its folder, or its only file."""
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop)
    # the file source lists folders: a single file is its folder, filtered by name
    df = reader.parquet(path) if status.isDirectory() else reader.option("pathGlobFilter", name).parquet(folder)
    return nan_to_null(df)


def daily_totals_stream(costed: DataFrame, ts: str = "ts") -> DataFrame:
    return costed.groupBy(day_string(F.col(ts)).alias("day")).agg(
        F.sum("cost_micro").cast("decimal(38,6)").alias("spent_micro"), F.count(F.lit(1)).alias("calls"),
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))


def latest_rows(rows: DataFrame) -> DataFrame:
    """Per day, the row written by the latest micro-batch."""
    value = F.struct("spent_micro", "calls", "input_tokens", "output_tokens", "batch_id")
    return rows.groupBy("day").agg(F.max_by(value, "batch_id").alias("r")).select("day", "r.*")


def start(totals: DataFrame, sink: CommitLog, checkpoint: str, compact_every: int = 16, available_now: bool = True) -> StreamingQuery:
    """Write ``totals`` into ``sink``; earlier batches are folded every ``compact_every`` batches."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            sink.compact(latest_rows, keep=(str(batch_id),))
            sink.vacuum()
        sink.append(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), str(batch_id))

    w = totals.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def finish(q: StreamingQuery, timeout_s: float | None, what: str) -> None:
    """Wait for an available-now stream; ``timeout_s`` (default: no limit) stops it with an error."""
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"{what} did not finish in {timeout_s} s")
    if q.exception():
        raise q.exception()


def read_latest(sink: CommitLog) -> DataFrame:
    """The current daily totals."""
    return latest_rows(sink.read()).select("day", (F.col("spent_micro").cast("double") / F.lit(1e6)).alias("spent_usd"),
                                           "calls", "input_tokens", "output_tokens")


def run_ledger(spark: SparkSession, path: str, max_files: int = 1, timeout_s: float | None = None,
               compact_every: int = 16) -> CommitLog:
    """Run the ledger stream over the files present (available-now); the sink."""
    base = scratch_path(spark, f"ledger_stream/{uuid.uuid4().hex}")
    sink = CommitLog(spark, f"{base}/sink", TOTALS_SCHEMA)
    costed = with_cost(usage_from_events(events_stream(spark, path, max_files)))
    finish(start(daily_totals_stream(costed), sink, f"{base}/checkpoint", compact_every), timeout_s, "ledger stream")
    return sink


def run_ledger_stream(spark: SparkSession, path: str, max_files: int = 1, timeout_s: float | None = None) -> DataFrame:
    """Run the ledger stream over the files present (available-now) and return its daily totals."""
    return read_latest(run_ledger(spark, path, max_files, timeout_s))

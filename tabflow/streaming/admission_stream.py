"""W3 as a stream: admit calls batch by batch against the day's spend so far.

The day totals live in a commit log, one row per (batch, day) the batch touched; every ``compact_every``
batches the earlier ones are folded to one row per day, so a batch opens a bounded number of folders. A
micro-batch reads the totals of earlier batches, adds the running spend of its own calls (the
bucketed prefix of ``ranking.running``: a day holding a third of all calls is many tasks), and
admits a call while the spend before it is under the limit. Calls are taken in arrival
order: batch by batch, by sequence inside a batch.

A batch's calls go to a folder named by its id and its totals are committed last, once: a replayed batch leaves its
own totals out, so it reads the same earlier totals and rewrites the same rows. Late calls are admitted against their own day's
total; no call is dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import day_string
from ..operators.ledger import DEFAULT_DAILY_LIMIT, with_cost
from ..operators.ranking import running
from ..session import scratch_path
from ..sources.commits import CommitLog
from ..sources.fixtures import usage_from_events
from .ledger_stream import events_stream, finish

MONEY = "decimal(38,6)"


def admit_batch(batch: DataFrame, totals: DataFrame, limit: float) -> DataFrame:
    """``(call_seq, day, cost, spent_before_micro, admitted)`` of one batch; ``totals(day, spent)`` is what came before."""
    r = running(batch, "call_seq", "cost", "sum", ("day",), True, "inside")
    earlier = totals.groupBy("day").agg(F.sum("spent").cast(MONEY).alias("earlier"))  # one row per day
    joined = r.join(earlier.withColumnRenamed("day", "d"), F.col("day").eqNullSafe(F.col("d")), "left").drop("d")
    before = (F.coalesce(F.col("earlier"), F.lit(0)) + F.col("inside")).cast(MONEY)
    limit_micro = F.lit(str(int(round(limit * 1e6)))).cast(MONEY)
    return joined.select("call_seq", "day", "cost", before.alias("spent_before_micro"), (before < limit_micro).alias("admitted"))


def run_admission_stream(spark: SparkSession, path: str, max_files: int = 1, limit: float = DEFAULT_DAILY_LIMIT,
                         timeout_s: float | None = None, compact_every: int = 16) -> DataFrame:
    """Run over the files present (available-now); return one row per call."""
    run = uuid.uuid4().hex
    out_path = scratch_path(spark, f"admission_stream/{run}/calls")
    totals = CommitLog(spark, scratch_path(spark, f"admission_stream/{run}/totals"), f"day string, spent {MONEY}")
    ckpt = scratch_path(spark, f"admission_stream/{run}/checkpoint")
    costed = with_cost(usage_from_events(events_stream(spark, path, max_files))).select(
        "call_seq", day_string(F.col("ts")).alias("day"), F.col("cost_micro").cast(MONEY).alias("cost"))

    def per_day(rows: DataFrame) -> DataFrame:
        return rows.groupBy("day").agg(F.sum("spent").cast(MONEY).alias("spent"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            totals.compact(per_day, keep=(str(batch_id),))
            totals.vacuum()
        seen = totals.read(without=(str(batch_id),))
        admit_batch(batch, seen, limit).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        # totals come last: a batch that fails before here is replayed whole
        totals.append(per_day(batch.withColumnRenamed("cost", "spent")), str(batch_id))

    finish(costed.writeStream.outputMode("append").foreachBatch(write_batch).option("checkpointLocation", ckpt)
           .trigger(availableNow=True).start(), timeout_s, "admission stream")
    t = spark.read.parquet(f"{out_path}/batch=*")
    return t.select("call_seq", "day", (F.col("spent_before_micro").cast("double") / F.lit(1e6)).alias("spent_before_usd"), "admitted")

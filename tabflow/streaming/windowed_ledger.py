"""ST1 by event time: daily totals as event-time windows with a watermark, late calls folded in as corrections.

``readStream`` -> price lookup -> per-task partial sums of each day (a day holding a third of all calls reaches
the state as a few rows per task) -> ``withWatermark`` -> the running totals of the open days. A day stays open until
the watermark (latest event time seen, less ``delay``) has passed its end. Days are dealt in turn to ``SHARDS``
state rows; a shard drops its closed days whenever calls reach it, which the next day of its turn does at the latest.
So the state has ``SHARDS`` rows (and one for calls without a time) with the days around the watermark, however long the stream runs.

Calls that arrive after their day has closed are not dropped: they leave the operator at once as a *correction*
(the sums of just these calls) and open no state again. A reader adds, per day, the latest total and all its
corrections, so the result always equals the batch ``ledger.daily_usage`` over the same calls.

Sink: each micro-batch is one batch of a ``CommitLog`` (a replayed batch is there already and changes nothing);
every ``compact_every`` batches the log is folded to one row per day and kind, so readers open a bounded number of
folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.scalar import day_string
from ..operators.ledger import with_cost
from ..session import scratch_path
from ..sources.commits import CommitLog
from ..sources.fixtures import usage_from_events
from .ledger_stream import events_stream, finish

# money is two longs: whole micro-USD and millionths of one, so per-task sums are exact
SHARDS = 8
PARTIAL = "shard int, day string, latest timestamp, micro long, rest long, calls long, input_tokens long, output_tokens long"
STATE = "open string"  # the shard's open days and their sums, as JSON
OUT = "day string, kind string, spent_micro decimal(38,6), calls long, input_tokens long, output_tokens long"
SINK = OUT + ", batch_id long"
_SUMS = ["micro", "rest", "calls", "input_tokens", "output_tokens"]
DAY_MS = 86_400_000


def partial_days(costed: DataFrame, ts: str = "ts") -> DataFrame:
    """Sums per day within each Arrow batch of the input (no state, no shuffle); a null time has no day and is its own group."""
    micro = F.floor("cost_micro")
    rows = costed.select(day_string(F.col(ts)).alias("day"), F.col(ts).cast("timestamp").alias("latest"), micro.cast("long").alias("micro"),
                         ((F.col("cost_micro") - micro) * 1_000_000).cast("long").alias("rest"), F.lit(1).cast("long").alias("calls"),
                         "input_tokens", "output_tokens")

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g = pdf.groupby("day", dropna=False, sort=False)
            out = g[_SUMS].sum()
            out["latest"] = g["latest"].max()
            out = out.reset_index()
            # the number of the day, dealt in turn; calls without a time have a shard of their own
            out["shard"] = [-1 if d is None or d != d else pd.Timestamp(d).toordinal() % SHARDS for d in out["day"]]
            yield out[["shard", "day", "latest", *_SUMS]]

    return rows.mapInPandas(add, PARTIAL)


def _row(day: str, kind: str, sums: list[int]) -> pd.DataFrame:
    micro, rest, calls, tokens_in, tokens_out = sums
    spent = Decimal(micro) + Decimal(rest) / 1_000_000
    return pd.DataFrame({"day": [day], "kind": [kind], "spent_micro": [spent.quantize(Decimal("0.000001"))], "calls": [calls],
                         "input_tokens": [tokens_in], "output_tokens": [tokens_out]})


def fold_days(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The open days of one shard: running totals, and corrections for days whose end the watermark has passed."""
    watermark = state.getCurrentWatermarkMs()

    def closed(day: str | None) -> bool:
        return day is None or pd.Timestamp(day).timestamp() * 1000 + DAY_MS <= watermark

    held: dict[str, list[int]] = json.loads(state.get[0]) if state.exists else {}
    new: dict[str | None, list[int]] = {}
    for pdf in frames:
        for day, *sums in pdf[["day", *_SUMS]].itertuples(index=False):
            day = day if isinstance(day, str) else None
            new[day] = [a + int(b) for a, b in zip(new.get(day, [0] * len(_SUMS)), sums)]
    for day, sums in new.items():
        if day in held:
            held[day] = [a + b for a, b in zip(held[day], sums)]
            yield _row(day, "total", held[day])
        elif closed(day):
            yield _row(day, "correction", sums)
        else:
            held[day] = sums
            yield _row(day, "total", sums)
    state.update((json.dumps({d: x for d, x in held.items() if not closed(d)}),))


def windowed_totals(costed: DataFrame, delay: str = "1 day", ts: str = "ts") -> DataFrame:
    """The streaming totals and corrections, one row per day that a micro-batch touches."""
    return (partial_days(costed, ts).withWatermark("latest", delay).groupBy("shard")
            .applyInPandasWithState(fold_days, OUT, STATE, "update", GroupStateTimeout.NoTimeout))


def folded(rows: DataFrame) -> DataFrame:
    """One row per day and kind: the latest total, the sum of all corrections."""
    value = F.struct("spent_micro", "calls", "input_tokens", "output_tokens")
    totals = (rows.where("kind = 'total'").groupBy("day").agg(F.max_by(value, "batch_id").alias("r"), F.max("batch_id").alias("batch_id"))
              .select("day", F.lit("total").alias("kind"), "r.*", "batch_id"))
    fixes = (rows.where("kind = 'correction'").groupBy("day").agg(
        F.sum("spent_micro").cast("decimal(38,6)").alias("spent_micro"), F.sum("calls").alias("calls"), F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"), F.max("batch_id").alias("batch_id"))
        .select("day", F.lit("correction").alias("kind"), "spent_micro", "calls", "input_tokens", "output_tokens", "batch_id"))
    return totals.unionByName(fixes)


def current(rows: DataFrame) -> DataFrame:
    """Daily usage from the sink's rows: total and corrections of every day."""
    return folded(rows).groupBy("day").agg((F.sum("spent_micro").cast("double") / F.lit(1e6)).alias("spent_usd"), F.sum("calls").alias("calls"),
                                           F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))


def start(totals: DataFrame, sink: CommitLog, checkpoint: str, compact_every: int = 16, available_now: bool = True) -> StreamingQuery:
    """Write ``totals`` into ``sink``; earlier batches are folded every ``compact_every`` batches."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            sink.compact(folded, keep=(str(batch_id),))
            sink.vacuum()
        sink.append(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), str(batch_id))

    w = totals.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def run_windowed_ledger(spark: SparkSession, path: str, max_files: int = 1, delay: str = "1 day", compact_every: int = 16,
                        timeout_s: float | None = None) -> tuple[CommitLog, StreamingQuery]:
    """Run over the files present (available-now); the sink and the ended query."""
    base = scratch_path(spark, f"windowed_ledger/{uuid.uuid4().hex}")
    sink = CommitLog(spark, f"{base}/sink", SINK)
    costed = with_cost(usage_from_events(events_stream(spark, path, max_files)))
    q = start(windowed_totals(costed, delay), sink, f"{base}/checkpoint", compact_every)
    finish(q, timeout_s, "windowed ledger")
    return sink, q

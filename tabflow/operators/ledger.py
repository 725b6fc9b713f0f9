"""Priced usage ledger: per-call cost, daily totals, budget checks and admission.

The ledger is the raw call table; daily totals are a query over it. Money is
exact: prices are DECIMAL and token counts integers, so per-call cost, daily
sums and running spend do not depend on summation order (partitioning), and
``spent < limit`` decides the same call on any cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import day_string
from .ranking import running

# USD per 1M tokens (input, output), and the default for models not listed.
MODEL_PRICES = [
    ("deepseek/deepseek-r1", 0.45, 2.15),
    ("deepseek/deepseek-chat", 0.32, 0.89),
    ("deepseek/deepseek-v3.2", 0.26, 0.38),
    ("deepseek/deepseek-v3.2-exp", 0.21, 0.41),
    ("deepseek/deepseek-chat-v3.1", 0.21, 0.79),
    ("qwen/qwen3-235b-a22b", 0.13, 0.60),
    ("qwen/qwen3-32b", 0.10, 0.40),
]
DEFAULT_PRICE = (0.55, 2.19)
DEFAULT_DAILY_LIMIT = 3.0

PRICE_TYPE = "decimal(12,6)"


def price_table(spark: SparkSession) -> DataFrame:
    # the decimal text of each price becomes an exact DECIMAL literal
    rows = ", ".join(f"('{m}', CAST('{i!s}' AS {PRICE_TYPE}), CAST('{o!s}' AS {PRICE_TYPE}))" for m, i, o in MODEL_PRICES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(model, input_usd_per_m, output_usd_per_m)")


def with_cost(usage: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Price lookup (unknown model -> default) and per-call cost in micro-USD (exact) and USD."""
    prices = prices if prices is not None else price_table(usage.sparkSession)
    p_in = F.coalesce(F.col("input_usd_per_m"), F.lit(str(DEFAULT_PRICE[0])).cast(PRICE_TYPE))
    p_out = F.coalesce(F.col("output_usd_per_m"), F.lit(str(DEFAULT_PRICE[1])).cast(PRICE_TYPE))
    micro = F.col("input_tokens") * p_in + F.col("output_tokens") * p_out  # USD * 1e6, exact
    # the price table has one row per priced model: a bounded broadcast
    return (usage.join(F.broadcast(prices), "model", "left")
                 .withColumn("cost_micro", micro)
                 .withColumn("cost_usd", F.col("cost_micro").cast("double") / F.lit(1e6))
                 .drop("input_usd_per_m", "output_usd_per_m"))


def daily_usage(costed: DataFrame, ts: str = "ts") -> DataFrame:
    """Per day: spend, calls, input and output tokens."""
    return costed.groupBy(day_string(F.col(ts)).alias("day")).agg(
        (F.sum("cost_micro").cast("double") / F.lit(1e6)).alias("spent_usd"),
        F.count(F.lit(1)).alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"))


def budget_status(daily: DataFrame, limit: float = DEFAULT_DAILY_LIMIT) -> DataFrame:
    """Spend, remaining and the strict check ``spent < limit`` per day."""
    return daily.select("day", "spent_usd", "calls",
                        (F.lit(limit) - F.col("spent_usd")).alias("remaining_usd"),
                        (F.col("spent_usd") < F.lit(limit)).alias("can_continue"))


def admission(costed: DataFrame, limit: float = DEFAULT_DAILY_LIMIT, seq: str = "call_seq", ts: str = "ts") -> DataFrame:
    """A call is admitted while the day's spend before it is under the limit.

    Costs are non-negative, so the running spend over all calls and over
    admitted calls cross the limit at the same call; the last admitted call may
    overshoot, as in the reference. The running sum is bucketed by sequence so
    a day holding a third of all calls is not one task.
    """
    staged = costed.withColumn("day", day_string(F.col(ts)))
    r = running(staged, seq, "cost_micro", "sum", ("day",), True, "spent_before_micro")
    limit_micro = F.lit(str(int(round(limit * 1e6)))).cast("decimal(38,0)")
    return (r.withColumn("spent_before_usd", F.col("spent_before_micro").cast("double") / F.lit(1e6))
             .withColumn("admitted", F.col("spent_before_micro") < limit_micro))

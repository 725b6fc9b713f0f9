"""Experiment-log analytics over the attempts table.

The reference keeps attempts in list order; here ``attempt_seq`` carries that
order. Best-of selections are ``max_by`` aggregates (partial per task, so a
campaign holding a third of the log still aggregates map-side); running bests
use the bucketed two-level window of ``ranking.running`` so no campaign is one
task; leaderboards and last-N are ``orderBy().limit()`` (TakeOrdered: a per-task
top-N, then a merge of N rows per task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import run_id, run_id_ts
from .ranking import running

# Slack under the best metric that still counts as failed, and the
# best metric assumed when no attempt succeeded.
FAILED_MARGIN = 0.01
FAILED_DEFAULT_BEST = 0.5


def status(error: Column | None = None, metric: Column | None = None) -> Column:
    """P10: ``error`` if there is error text, ``success`` if there is a metric, else ``no_metric``.

    Empty error text counts as no error; a 0.0 metric is a metric (null is the only missing value).
    """
    error = F.col("error") if error is None else error
    metric = F.col("roc_auc") if metric is None else metric
    return (F.when(F.coalesce(error, F.lit("")) != "", "error")
             .when(metric.isNotNull(), "success")
             .otherwise("no_metric"))


def with_run_id(df: DataFrame, ts: str = "ts", agent: str = "agent_id") -> DataFrame:
    """derive ``run_<yyyyMMdd_HHmmss>_a<agent>`` when the log has no run id."""
    return df.withColumn("run_id", run_id(F.col(ts), F.col(agent)))


def _rank_key(metric: str = "roc_auc", seq: str = "attempt_seq") -> Column:
    # higher metric first, earlier attempt wins a tie
    return F.struct(F.col(metric), -F.col(seq))


def best(df: DataFrame, by: list[str] | None = None, metric: str = "roc_auc", seq: str = "attempt_seq",
         cols: list[str] | None = None) -> DataFrame:
    """The best attempt (overall or per group) among attempts with a metric."""
    by = by or []
    cols = cols or [c for c in df.columns if c not in by]
    rec = F.struct(*[F.col(c) for c in cols])
    g = df.where(F.col(metric).isNotNull())
    agg = F.max_by(rec, _rank_key(metric, seq)).alias("__best")
    res = g.groupBy(*by).agg(agg) if by else g.agg(agg)
    return res.where(F.col("__best").isNotNull()).select(*by, "__best.*")


def campaign_totals(df: DataFrame, by: str = "campaign", metric: str = "roc_auc", seq: str = "attempt_seq") -> DataFrame:
    """Attempts, successes, best metric and which attempt reached it, per campaign."""
    m = F.col(metric)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.count_if(m.isNotNull()).alias("n_success"),
        F.max(m).alias("best_auc"),
        F.max_by(F.when(m.isNotNull(), F.col(seq)), F.when(m.isNotNull(), _rank_key(metric, seq))).alias("best_attempt_seq"),
    )


def leaderboard(df: DataFrame, n: int = 20, metric: str = "roc_auc", seq: str = "attempt_seq") -> DataFrame:
    """O1: top-n by metric descending (null ranks as 0), stable by attempt order; ``position`` 1..n."""
    key = F.coalesce(F.col(metric), F.lit(0.0))
    top = df.withColumn("__k", key).orderBy(F.col("__k").desc(), F.col(seq).asc()).limit(n)
    w = Window.orderBy(F.col("__k").desc(), F.col(seq).asc())  # over at most n rows
    return top.withColumn("position", F.row_number().over(w)).drop("__k")


def last_n(df: DataFrame, n: int = 15, seq: str = "attempt_seq") -> DataFrame:
    """The last n attempts, with ``position`` 1..n in log order."""
    tail = df.orderBy(F.col(seq).desc()).limit(n)
    return tail.withColumn("position", F.row_number().over(Window.orderBy(seq)))


def failed_approaches(df: DataFrame, metric: str = "roc_auc", text: str = "approach_description",
                      seq: str = "attempt_seq", width: int = 150) -> DataFrame:
    """Attempts without a metric or more than 0.01 under the best (0.5 when none); text cut to 150."""
    best_val = df.select(F.coalesce(F.max(metric), F.lit(FAILED_DEFAULT_BEST))).scalar()  # scalar subquery
    m = F.col(metric)
    return (df.where(m.isNull() | (m < best_val - F.lit(FAILED_MARGIN)))
              .select(seq, F.substring(text, 1, width).alias("approach")))


def metric_delta(df: DataFrame, by: str = "campaign", metric: str = "roc_auc", seq: str = "attempt_seq") -> DataFrame:
    """Best metric before each attempt in its campaign, the delta to it, and a new-best flag."""
    r = running(df, seq, metric, "max", (by,), True, "best_before")
    m = F.col(metric)
    return (r.withColumn("delta", m - F.col("best_before"))
             .withColumn("new_best", F.coalesce(m > F.coalesce(F.col("best_before"), F.lit(-1.0)), F.lit(False))))


def history_lines(df: DataFrame, n: int = 15, metric: str = "roc_auc", seq: str = "attempt_seq") -> DataFrame:
    """The last n attempts as fixed-width text fields (approach 200, analysis 300, error 150 characters)."""
    tail = last_n(df, n, seq)
    m = F.col(metric)
    head = F.concat(F.lit("["), F.col("run_id"), F.lit("] ROC-AUC: "),
                    F.when(m.isNotNull(), F.format_string("%.6f", m)).otherwise(F.lit("N/A (error)")))
    fields = [seq, "position", head.alias("header"),
              F.substring(F.coalesce(F.col("approach_description"), F.lit("")), 1, 200).alias("approach")]
    if "agent_analysis" in df.columns:
        fields.append(F.substring(F.coalesce(F.col("agent_analysis"), F.lit("")), 1, 300).alias("analysis"))
    fields.append(F.substring(F.col("error"), 1, 150).alias("error"))
    return tail.select(*fields)


def history_header(df: DataFrame, n: int = 15, metric: str = "roc_auc", seq: str = "attempt_seq") -> DataFrame:
    """The head of the history: attempts shown, the best metric so far and its run (null without a metric)."""
    a = df.agg(F.count(F.lit(1)).alias("c"), F.max_by(
        F.when(F.col(metric).isNotNull(), F.struct(F.col("run_id").alias("run"), F.col(metric).alias("m"))),
        F.when(F.col(metric).isNotNull(), _rank_key(metric, seq))).alias("b"))
    return a.select(F.least("c", F.lit(n)).alias("n_shown"), F.col("c").alias("n_attempts"), F.col("b.run").alias("best_run"),
                    F.format_string("ROC-AUC = %.6f", F.col("b.m")).alias("best"))


def parse_run_id(run: Column) -> Column:
    """F10 backwards: ``struct<ts, agent_id>`` of a run id, nulls if it is none."""
    return F.struct(run_id_ts(run).alias("ts"), F.regexp_extract(run, r"_a([0-9]+)$", 1).try_cast("int").alias("agent_id"))


def tail_text(text: Column, width: int) -> Column:
    """The last ``width`` characters (log output is cut from the front)."""
    return F.when(F.length(text) > width, F.right(text, F.lit(width))).otherwise(text)

"""Registered queries over the attempts log and the usage ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attempts as A
from ..operators import ledger as L
from ..sources import fixtures as fx
from .registry import register

_STATUS_SQL = ("CASE WHEN coalesce(error, '') <> '' THEN 'error' WHEN roc_auc IS NOT NULL THEN 'success' "
               "ELSE 'no_metric' END")


def _attempts(spark, sf_dir):
    return fx.attempts(spark, sf_dir)


@register("attempt_status_counts", "P10 P8", fx.with_views(
    f"SELECT {_STATUS_SQL} AS status, count(*) AS n FROM attempts GROUP BY 1", "attempts"))
def attempt_status_counts(spark, sf_dir):
    a = _attempts(spark, sf_dir).withColumn("status", A.status())
    return a.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("best_attempt", "A15 P8", fx.with_views(
    "SELECT attempt_seq, campaign, agent_id, roc_auc FROM attempts WHERE roc_auc IS NOT NULL "
    "ORDER BY roc_auc DESC, attempt_seq LIMIT 1", "attempts"))
def best_attempt(spark, sf_dir):
    return A.best(_attempts(spark, sf_dir), cols=["attempt_seq", "campaign", "agent_id", "roc_auc"])


@register("best_per_round", "A16 U1", fx.with_views(
    "SELECT round, attempt_seq, agent_id, roc_auc FROM (SELECT *, row_number() OVER (PARTITION BY round "
    "ORDER BY roc_auc DESC, attempt_seq) AS rn FROM attempts WHERE roc_auc IS NOT NULL) t WHERE rn = 1", "attempts"))
def best_per_round(spark, sf_dir):
    return A.best(_attempts(spark, sf_dir), by=["round"], cols=["attempt_seq", "agent_id", "roc_auc"])


@register("campaign_totals", "A17", fx.with_views(
    "SELECT t.campaign, t.n_attempts, t.n_success, t.best_auc, b.attempt_seq AS best_attempt_seq FROM "
    "(SELECT campaign, count(*) AS n_attempts, count(roc_auc) AS n_success, max(roc_auc) AS best_auc "
    " FROM attempts GROUP BY campaign) t LEFT JOIN "
    "(SELECT campaign, attempt_seq, row_number() OVER (PARTITION BY campaign ORDER BY roc_auc DESC, attempt_seq) AS rn "
    " FROM attempts WHERE roc_auc IS NOT NULL) b ON t.campaign = b.campaign AND b.rn = 1", "attempts"))
def campaign_totals(spark, sf_dir):
    return A.campaign_totals(_attempts(spark, sf_dir))


@register("leaderboard", "O1", fx.with_views(
    "SELECT attempt_seq, campaign, roc_auc, position FROM (SELECT attempt_seq, campaign, roc_auc, "
    "CAST(row_number() OVER (ORDER BY coalesce(roc_auc, 0) DESC, attempt_seq) AS INTEGER) AS position "
    "FROM attempts) t WHERE position <= 20", "attempts"))
def leaderboard(spark, sf_dir):
    a = _attempts(spark, sf_dir).select("attempt_seq", "campaign", "roc_auc")
    return A.leaderboard(a, 20)


@register("attempt_history", "O4 P13 F7 F8 F10", fx.with_views(
    "SELECT attempt_seq, position, concat('[', 'run_' || strftime(ts, '%Y%m%d_%H%M%S') || '_a' || CAST(agent_id AS VARCHAR), "
    "'] ROC-AUC: ', CASE WHEN roc_auc IS NOT NULL THEN printf('%.6f', roc_auc) ELSE 'N/A (error)' END) AS header, "
    "substr(coalesce(approach_description, ''), 1, 200) AS approach, substr(coalesce(agent_analysis, ''), 1, 300) AS analysis, substr(error, 1, 150) AS error FROM "
    "(SELECT *, CAST(row_number() OVER (ORDER BY attempt_seq) AS INTEGER) AS position FROM "
    "(SELECT * FROM attempts ORDER BY attempt_seq DESC LIMIT 15) l) t", "attempts"))
def attempt_history(spark, sf_dir):
    a = A.with_run_id(_attempts(spark, sf_dir))
    return A.history_lines(a, 15)


_RUN = "'run_' || strftime(ts, '%Y%m%d_%H%M%S') || '_a' || CAST(agent_id AS VARCHAR)"


@register("history_header", "P13 A15", fx.with_views(
    f"SELECT least(count(*), 15) AS n_shown, count(*) AS n_attempts, (SELECT {_RUN} FROM attempts WHERE roc_auc IS NOT NULL "
    "ORDER BY roc_auc DESC, attempt_seq LIMIT 1) AS best_run, 'ROC-AUC = ' || printf('%.6f', max(roc_auc)) AS best FROM attempts", "attempts"))
def history_header(spark, sf_dir):
    return A.history_header(A.with_run_id(_attempts(spark, sf_dir)), 15)


@register("run_id_parts", "F10", fx.with_views(
    "SELECT attempt_seq, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS ts_seconds, CAST(agent_id AS INTEGER) AS agent_id, "
    "CASE WHEN length(agent_analysis) > 60 THEN right(agent_analysis, 60) ELSE agent_analysis END AS tail FROM attempts", "attempts"))
def run_id_parts(spark, sf_dir):
    a = A.with_run_id(_attempts(spark, sf_dir)).withColumn("p", A.parse_run_id(F.col("run_id")))
    return a.select("attempt_seq", F.unix_timestamp("p.ts").alias("ts_seconds"), F.col("p.agent_id").alias("agent_id"),
                    A.tail_text(F.col("agent_analysis"), 60).alias("tail"))


@register("failed_approaches", "P9 F7", fx.with_views(
    "SELECT attempt_seq, substr(approach_description, 1, 150) AS approach FROM attempts "
    "WHERE roc_auc IS NULL OR roc_auc < (SELECT coalesce(max(roc_auc), 0.5) FROM attempts) - 0.01", "attempts"))
def failed_approaches(spark, sf_dir):
    return A.failed_approaches(_attempts(spark, sf_dir))


@register("metric_delta", "W1 W2", fx.with_views(
    "SELECT attempt_seq, campaign, best_before, round(roc_auc - best_before, 12) AS delta, "
    "coalesce(roc_auc > coalesce(best_before, -1.0), FALSE) AS new_best FROM (SELECT *, max(roc_auc) OVER "
    "(PARTITION BY campaign ORDER BY attempt_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before "
    "FROM attempts) t", "attempts"))
def metric_delta(spark, sf_dir):
    r = A.metric_delta(_attempts(spark, sf_dir).select("attempt_seq", "campaign", "roc_auc"))
    return r.select("attempt_seq", "campaign", "best_before", F.round("delta", 12).alias("delta"), "new_best")


@register("metric_delta_null_campaign", "W1 W2", fx.with_views(
    "SELECT attempt_seq, campaign, best_before, round(roc_auc - best_before, 12) AS delta, "
    "coalesce(roc_auc > coalesce(best_before, -1.0), FALSE) AS new_best FROM (SELECT *, max(roc_auc) OVER "
    "(PARTITION BY campaign ORDER BY attempt_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before "
    "FROM (SELECT attempt_seq, nullif(campaign, 'c0') AS campaign, roc_auc FROM attempts) a) t", "attempts"))
def metric_delta_null_campaign(spark, sf_dir):
    a = _attempts(spark, sf_dir).select("attempt_seq", F.nullif("campaign", F.lit("c0")).alias("campaign"), "roc_auc")
    r = A.metric_delta(a)
    return r.select("attempt_seq", "campaign", "best_before", F.round("delta", 12).alias("delta"), "new_best")


# ------------------------------------------------------------------ ledger

def _prices_sql() -> str:
    rows = ", ".join(f"('{m}', CAST({i} AS DECIMAL(12,6)), CAST({o} AS DECIMAL(12,6)))" for m, i, o in L.MODEL_PRICES)
    return f"SELECT * FROM (VALUES {rows}) AS t(model, input_usd_per_m, output_usd_per_m)"


_COSTED = (
    "SELECT u.*, u.input_tokens * coalesce(p.input_usd_per_m, CAST({di} AS DECIMAL(12,6))) "
    "+ u.output_tokens * coalesce(p.output_usd_per_m, CAST({do} AS DECIMAL(12,6))) AS cost_micro, "
    "strftime(CAST(u.ts AS DATE), '%Y-%m-%d') AS day "
    "FROM usage u LEFT JOIN prices p ON u.model = p.model").format(di=L.DEFAULT_PRICE[0], do=L.DEFAULT_PRICE[1])

DAILY_SQL = ("SELECT day, round(CAST(sum(cost_micro) AS DOUBLE) / 1e6, 8) AS spent_usd, count(*) AS calls, "
             "CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens "
             "FROM costed GROUP BY day")


def _ledger_sql(select: str) -> str:
    return fx.with_views(select, "usage", extra={"prices": _prices_sql(), "costed": _COSTED})


def _costed(spark, sf_dir):
    return L.with_cost(fx.usage(spark, sf_dir))


@register("usage_cost", "J3", _ledger_sql(
    "SELECT call_seq, model, round(CAST(cost_micro AS DOUBLE) / 1e6, 10) AS cost_usd FROM costed"))
def usage_cost(spark, sf_dir):
    return _costed(spark, sf_dir).select("call_seq", "model", F.round("cost_usd", 10).alias("cost_usd"))


@register("daily_usage", "A13 F9", _ledger_sql(DAILY_SQL))
def daily_usage(spark, sf_dir):
    d = L.daily_usage(_costed(spark, sf_dir))
    return d.withColumn("spent_usd", F.round("spent_usd", 8))


@register("budget_status", "A14 P12", _ledger_sql(
    f"SELECT day, spent_usd, calls, round({L.DEFAULT_DAILY_LIMIT} - spent_usd, 8) AS remaining_usd, "
    f"spent_usd < {L.DEFAULT_DAILY_LIMIT} AS can_continue FROM (SELECT day, CAST(sum(cost_micro) AS DOUBLE) / 1e6 AS spent_usd, "
    "count(*) AS calls FROM costed GROUP BY day) d").replace(
    "SELECT day, spent_usd, calls,", "SELECT day, round(spent_usd, 8) AS spent_usd, calls,", 1))
def budget_status(spark, sf_dir):
    s = L.budget_status(L.daily_usage(_costed(spark, sf_dir)), L.DEFAULT_DAILY_LIMIT)
    return s.select("day", F.round("spent_usd", 8).alias("spent_usd"), "calls",
                    F.round("remaining_usd", 8).alias("remaining_usd"), "can_continue")


@register("budget_admission", "W3 P12", _ledger_sql(
    "SELECT call_seq, day, round(CAST(sb AS DOUBLE) / 1e6, 8) AS spent_before_usd, "
    f"sb < CAST({int(L.DEFAULT_DAILY_LIMIT * 1e6)} AS DECIMAL(38,0)) AS admitted FROM (SELECT call_seq, day, "
    "coalesce(sum(cost_micro) OVER (PARTITION BY day ORDER BY call_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    "AS sb FROM costed) t"))
def budget_admission(spark, sf_dir):
    r = L.admission(_costed(spark, sf_dir), L.DEFAULT_DAILY_LIMIT)
    return r.select("call_seq", "day", F.round("spent_before_usd", 8).alias("spent_before_usd"), "admitted")


@register("daily_usage_stream", "ST1 A13", _ledger_sql(DAILY_SQL))
def daily_usage_stream(spark, sf_dir):
    from ..streaming.ledger_stream import run_ledger_stream
    d = run_ledger_stream(spark, f"{sf_dir}/events.parquet")
    return d.withColumn("spent_usd", F.round("spent_usd", 8))



@register("attempts_log_roundtrip", "S11 P10", fx.with_views(
    f"SELECT {_STATUS_SQL} AS status, count(*) AS n, round(sum(duration_seconds), 6) AS duration_seconds "
    "FROM attempts GROUP BY 1", "attempts"))
def attempts_log_roundtrip(spark, sf_dir):
    import uuid
    from ..session import scratch_path
    from ..sources import tables as TB
    path = scratch_path(spark, f"logs/attempts/{uuid.uuid4().hex}")
    a = A.with_run_id(_attempts(spark, sf_dir)).withColumn("status", A.status())
    log = a.select(
        "attempt_seq", "run_id", F.col("agent_id").cast("int").alias("agent_id"), F.col("round").cast("int").alias("round"),
        "campaign", F.col("ts").cast("timestamp").alias("timestamp"), "roc_auc", "approach_description",
        "agent_analysis", "error", F.lit(0.0).alias("cost_usd"),
        "duration_seconds", "status")
    TB.append_log(log, path, TB.ATTEMPT_SCHEMA, "all")
    back = TB.read_log(spark, path, TB.ATTEMPT_SCHEMA)
    return back.groupBy("status").agg(F.count(F.lit(1)).alias("n"),
                                      F.round(F.sum("duration_seconds"), 6).alias("duration_seconds"))


@register("usage_log_roundtrip", "S12 A13", _ledger_sql(DAILY_SQL))
def usage_log_roundtrip(spark, sf_dir):
    import uuid
    from ..session import scratch_path
    from ..sources import tables as TB
    path = scratch_path(spark, f"logs/usage/{uuid.uuid4().hex}")
    u = fx.usage(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    TB.append_log(u, path, TB.USAGE_SCHEMA, "all")
    back = TB.read_log(spark, path, TB.USAGE_SCHEMA)
    return L.daily_usage(L.with_cost(back)).withColumn("spent_usd", F.round("spent_usd", 8))


@register("usage_log_exactly_once", "S12 S11 A13", _ledger_sql(DAILY_SQL))
def usage_log_exactly_once(spark, sf_dir):
    """Four batches of calls, one written again, one by two writers, compacted in between: every call counts once."""
    import uuid
    from ..session import scratch_path
    from ..sources.commits import CommitLog
    from ..sources import tables as TB
    u = fx.usage(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    path = scratch_path(spark, f"logs/usage/{uuid.uuid4().hex}")
    log, other = (CommitLog(spark, path, TB.USAGE_SCHEMA) for _ in range(2))
    part = [u.where(F.col("call_seq") % 4 == i) for i in range(4)]
    log.append(part[0], "0")
    log.append(part[1], "1")
    log.append(part[1], "1")
    log.compact()
    other.append(part[2], "2")
    log.append(part[2], "2")
    other.append(part[0], "0")
    log.append(part[3], "3")
    return L.daily_usage(L.with_cost(log.read())).withColumn("spent_usd", F.round("spent_usd", 8))



@register("run_meta_scan", "S13 U1", fx.with_views(
    "SELECT campaign || '_a' || CAST(agent_id AS VARCHAR) || '_r' || CAST(round AS VARCHAR) AS run_id, "
    "CAST(agent_id AS INTEGER) AS agent_id, max(roc_auc) AS roc_auc, round(sum(duration_seconds), 6) AS duration_seconds "
    "FROM attempts GROUP BY campaign, agent_id, round", "attempts"))
def run_meta_scan(spark, sf_dir):
    import uuid
    from ..session import scratch_path
    from ..sources import tables as TB
    base = scratch_path(spark, f"runs/{uuid.uuid4().hex}")
    runs = (_attempts(spark, sf_dir)
            .groupBy("campaign", "agent_id", "round")
            .agg(F.max("roc_auc").alias("roc_auc"), F.sum("duration_seconds").alias("d"))
            .select(F.concat("campaign", F.lit("_a"), F.col("agent_id").cast("string"), F.lit("_r"),
                             F.col("round").cast("string")).alias("run_id"),
                    F.col("agent_id").cast("int").alias("agent_id"), "roc_auc",
                    F.lit(None).cast("string").alias("error"),
                    # both spellings occur in metadata files: even rounds write one, odd rounds the other
                    F.when(F.col("round") % 2 == 0, F.col("d")).alias("duration_seconds"),
                    F.when(F.col("round") % 2 == 1, F.col("d")).alias("duration_sec")))
    TB.write_run_meta(runs, base)  # a folder per run, one JSON document in it
    meta = TB.read_run_meta(spark, base)
    return meta.select("run_id", "agent_id", "roc_auc", F.round("duration_seconds", 6).alias("duration_seconds"))


@register("budget_admission_stream", "W3 ST1 P12", _ledger_sql(
    "SELECT call_seq, day, round(CAST(sb AS DOUBLE) / 1e6, 8) AS spent_before_usd, "
    f"sb < CAST({int(L.DEFAULT_DAILY_LIMIT * 1e6)} AS DECIMAL(38,0)) AS admitted FROM (SELECT call_seq, day, "
    "coalesce(sum(cost_micro) OVER (PARTITION BY day ORDER BY call_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    "AS sb FROM costed) t"))
def budget_admission_stream(spark, sf_dir):
    from ..streaming.admission_stream import run_admission_stream
    r = run_admission_stream(spark, f"{sf_dir}/events.parquet")
    return r.select("call_seq", "day", F.round("spent_before_usd", 8).alias("spent_before_usd"), "admitted")


def _newest_first(spark, sf_dir) -> str:
    """The call table rewritten as three files that arrive newest days first."""
    import uuid
    from ..session import scratch_path
    from ..sources.tables import read_table
    path = scratch_path(spark, f"late_events/{uuid.uuid4().hex}")
    e = read_table(spark, sf_dir, "events")
    lo, hi = e.agg(F.percentile_approx("event_id", 0.33), F.percentile_approx("event_id", 0.66)).first()
    i = F.col("event_id")
    for part in (e.where(i >= hi), e.where((i >= lo) & (i < hi)), e.where(i < lo)):
        part.coalesce(1).write.mode("append").parquet(path)
    return path


@register("daily_usage_stream_late", "ST1 A13", _ledger_sql(DAILY_SQL))
def daily_usage_stream_late(spark, sf_dir):
    from ..streaming.ledger_stream import run_ledger_stream
    return run_ledger_stream(spark, _newest_first(spark, sf_dir)).withColumn("spent_usd", F.round("spent_usd", 8))


@register("daily_usage_windowed", "ST1 A13", _ledger_sql(DAILY_SQL))
def daily_usage_windowed(spark, sf_dir):
    """Newest days arrive first, so most calls are later than the watermark: corrections make up the totals."""
    from ..streaming.windowed_ledger import current, run_windowed_ledger
    sink, _ = run_windowed_ledger(spark, _newest_first(spark, sf_dir))
    return current(sink.read()).withColumn("spent_usd", F.round("spent_usd", 8))


@register("admission_stream_late", "W3 ST1 P12", _ledger_sql(
    "SELECT day, count(*) AS calls, round(CAST(max(spent) AS DOUBLE) / 1e6, 8) AS spent_usd FROM "
    "(SELECT day, sum(cost_micro) OVER (PARTITION BY day) AS spent FROM costed) t GROUP BY day"))
def admission_stream_late(spark, sf_dir):
    """Every call arrives once, whatever the order: per day the spend before the last call plus its cost is the total."""
    from ..streaming.admission_stream import run_admission_stream
    r = run_admission_stream(spark, _newest_first(spark, sf_dir))
    cost = _costed(spark, sf_dir).select("call_seq", "cost_usd")
    after = r.join(cost, "call_seq").withColumn("after", F.col("spent_before_usd") + F.col("cost_usd"))
    return after.groupBy("day").agg(F.count(F.lit(1)).alias("calls"), F.round(F.max("after"), 8).alias("spent_usd"))


@register("tried_approaches", "P13 W5 F7", fx.with_views(
    "SELECT attempt_seq, row_number() OVER (ORDER BY attempt_seq) AS position, "
    "substr(approach_description, 1, 100) AS approach FROM attempts", "attempts"))
def tried_approaches(spark, sf_dir):
    from ..operators.ranking import row_index
    a = _attempts(spark, sf_dir).select("attempt_seq", "approach_description")
    r = row_index(a, "attempt_seq", "idx")
    return r.select("attempt_seq", (F.col("idx") + 1).alias("position"),
                    F.substring("approach_description", 1, 100).alias("approach"))

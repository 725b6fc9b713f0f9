"""Event-time ledger: late calls become corrections, state and sink stay bounded, totals equal the batch."""

import datetime as dt
import json
import random
from decimal import Decimal

import pandas as pd

from tabflow.operators import ledger as L
from tabflow.sources import fixtures as fx
from tabflow.streaming import ledger_stream as S
from tabflow.streaming import windowed_ledger as W

T0 = dt.datetime(2024, 1, 1)


class FakeState:
    """What ``fold_days`` uses of a group state."""

    def __init__(self):
        self.value, self.watermark = None, 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.value = value


def test_state_is_bounded_over_a_thousand_batches():
    rnd, states, rows, want = random.Random(3), {}, [], {}
    newest = 0
    for batch in range(1000):
        now = batch * 3 * W.DAY_MS // 10  # three tenths of a day a batch, some calls days late
        days = [max(0, now // W.DAY_MS - rnd.choice([0, 0, 0, 1, 5, 200])) for _ in range(6)] + [None] * (batch % 50 == 0)
        by_shard = {}
        for n in days:
            day = None if n is None else str((T0 + dt.timedelta(days=n)).date())
            want[day] = want.get(day, 0) + 1
            shard = -1 if n is None else pd.Timestamp(day).toordinal() % W.SHARDS
            by_shard.setdefault(shard, []).append((day, 5, 250_000, 1, 10, 20))
        for shard, calls in by_shard.items():
            s = states.setdefault(shard, FakeState())
            s.watermark = newest - W.DAY_MS
            for out in W.fold_days((shard,), iter([pd.DataFrame(calls, columns=["day", *W._SUMS])]), s):
                rows.append((*out.iloc[0][["day", "kind", "calls", "spent_micro"]], batch))
            assert len(json.loads(s.value[0])) <= 2
        newest = max(newest, int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) + now)
    assert len(states) <= W.SHARDS + 1
    got, spent = {}, {}
    for day in want:
        totals = [(b, c, m) for d, k, c, m, b in rows if d == day and k == "total"]
        fixes = [(c, m) for d, k, c, m, b in rows if d == day and k == "correction"]
        last = max(totals) if totals else (0, 0, Decimal(0))
        got[day], spent[day] = last[1] + sum(c for c, _ in fixes), last[2] + sum((m for _, m in fixes), Decimal(0))
    assert got == want and any(k == "correction" for _, k, *_ in rows)
    assert all(spent[d] == n * Decimal("5.25") for d, n in want.items())


def test_stream_equals_batch_with_late_calls(spark, tmp_path):
    rnd, n = random.Random(1), 0
    for f in range(24):
        rows = []
        for _ in range(20):
            day = max(0, f * 2 - rnd.choice([0, 0, 0, 1, 3, 30]))
            ts = None if rnd.random() < 0.02 else T0 + dt.timedelta(days=day, seconds=rnd.randrange(86400))
            rows.append((n, ts, n % 7, "x", rnd.random() * 100, f"p{rnd.randrange(900)}"))
            n += 1
        spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                              ).coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    sink, q = W.run_windowed_ledger(spark, str(tmp_path / "events"), compact_every=4)
    states = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert states and max(states) <= W.SHARDS + 1
    assert sink.folders() <= 5 and len(sink.batches()) >= 24
    assert sink.read().where("kind = 'correction'").count() > 0
    got = {r.day: (round(r.spent_usd, 9), r.calls, r.input_tokens, r.output_tokens) for r in W.current(sink.read()).collect()}
    usage = fx.usage_from_events(spark.read.parquet(str(tmp_path / "events")))
    want = {r.day: (round(r.spent_usd, 9), r.calls, r.input_tokens, r.output_tokens) for r in L.daily_usage(L.with_cost(usage)).collect()}
    assert got == want


def test_plain_ledger_keeps_few_folders_and_every_call(spark, tmp_path):
    rnd = random.Random(4)
    for f in range(14):
        rows = [(f * 9 + i, None if i == 8 and f % 5 == 0 else T0 + dt.timedelta(days=max(0, f - rnd.choice([0, 0, 1, 9])), seconds=i),
                 i, "x", rnd.random() * 100, f"p{i}") for i in range(9)]
        spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                              ).coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    sink = S.run_ledger(spark, str(tmp_path / "events"), compact_every=4)
    assert len(sink.batches()) >= 14 and sink.folders() <= 5
    again = sink.read().where("batch_id = 13")
    assert not sink.append(again, "13") and not sink.append(again, "2")  # replays, also of a folded batch
    sink.compact(S.latest_rows)
    assert sink.folders() == 1 and sink.read().groupBy("day").count().where("count > 1").isEmpty()
    got = {r.day: (round(r.spent_usd, 9), r.calls, r.input_tokens, r.output_tokens) for r in S.read_latest(sink).collect()}
    usage = fx.usage_from_events(spark.read.parquet(str(tmp_path / "events")))
    want = {r.day: (round(r.spent_usd, 9), r.calls, r.input_tokens, r.output_tokens) for r in L.daily_usage(L.with_cost(usage)).collect()}
    assert got == want and None in got


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    sink = W.CommitLog(spark, str(tmp_path / "sink"), W.SINK)
    rows = spark.createDataFrame([("2024-01-01", "total", Decimal("1.5"), 1, 2, 3, 0), ("2024-01-01", "correction", Decimal("0.5"), 1, 1, 1, 1)], W.SINK)
    sink.append(rows.where("batch_id = 0"), "0")
    sink.append(rows.where("batch_id = 1"), "1")
    sink.append(rows.where("batch_id = 1"), "1")
    sink.compact(W.folded)
    sink.append(rows.where("batch_id = 1"), "1")
    assert W.current(sink.read()).first().asDict() == {"day": "2024-01-01", "spent_usd": 2e-6, "calls": 2, "input_tokens": 3, "output_tokens": 4}

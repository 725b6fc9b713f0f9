"""Sticky split: no key moves, quotas carried per class, increments run again or overlapping."""

import random

import pytest

from tabflow.operators import sticky_split as K
from tabflow.operators.split import quotas, stratified_split

KEY = ["a", "b"]


def table(spark, rows):
    return spark.createDataFrame(rows, "a long, b string, target int, x double")


@pytest.mark.parametrize("parts", [1, 5])
def test_no_key_moves_and_quotas_hold(spark, tmp_path, parts):
    rnd = random.Random(parts)
    rows = [(i, None if i % 11 == 0 else f"b{i % 3}", int(rnd.random() < 0.3), float(i)) for i in range(900)]
    log = K.assignment_log(spark, str(tmp_path / "log"), table(spark, rows[:1]), KEY, "target")
    old, at = {}, 0
    for step, n in enumerate([300, 301, 1, 2, 50, 246]):
        increment = rows[max(0, at - 40):at + n]  # overlaps the one before
        at += n
        df = table(spark, increment + increment[:5]).repartition(parts)
        assert K.assign(log, df, KEY, f"day{step}") and not K.assign(log, df, KEY, f"day{step}")
        now = {(r.a, r.b): (r["class"], r.split) for r in log.read().collect()}
        assert len(now) == at == log.read().count()
        assert all(now[k] == v for k, v in old.items())
        counts = {c: sum(v[0] == c for v in now.values()) for c in (0, 1)}
        goal = quotas(counts, 0.2)
        for c in (0, 1):
            assert abs(sum(v == (c, "val") for v in now.values()) - goal[c]) <= 1
        old = now
    done = K.with_split(table(spark, rows), log, KEY)
    assert done.count() == 900 and done.where("split is null").count() == 0


def test_first_increment_equals_the_plain_split(spark, tmp_path):
    df = table(spark, [(i, "b", i % 2, 0.0) for i in range(200)])
    log = K.assignment_log(spark, str(tmp_path / "log"), df, KEY, "target")
    K.assign(log, df, KEY, "1")
    plain = {r.a: r.split for r in stratified_split(df.select("a", "b", "target"), KEY).collect()}
    assert {r.a: r.split for r in log.read().collect()} == plain


def test_empty_increment_new_class_and_null_labels(spark, tmp_path):
    df = table(spark, [(i, "b", i % 2, 0.0) for i in range(100)])
    log = K.assignment_log(spark, str(tmp_path / "log"), df, KEY, "target")
    K.assign(log, df, KEY, "1")
    assert K.assign(log, df.limit(0), KEY, "2") and K.assign(log, df, KEY, "3") and log.read().count() == 100
    K.assign(log, table(spark, [(i, "b", 2, 0.0) for i in range(100, 150)]), KEY, "4")
    assert log.read().where("class = 2 and split = 'val'").count() == 10
    with pytest.raises(ValueError, match="null labels"):
        K.assign(log, table(spark, [(999, "b", None, 0.0)]), KEY, "5")

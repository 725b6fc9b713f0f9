"""Mergeable profile states: equal to the profile of the union, errors of the sketches within their bounds."""

import random

import pytest

from tabflow.operators import profile as P
from tabflow.operators import profile_state as PS

SCHEMA = "x double, n int, flag boolean, cat string, code string, user_id string, free string, day date, target int"
EXACT = ["column", "position", "role", "dtype", "null_pct", "zeros_pct", "min", "max"]


def frame(spark, n, seed=0, codes=900):
    rnd = random.Random(seed)
    rows = [(None if rnd.random() < 0.1 else rnd.gauss(1e6, 3), rnd.randrange(5), rnd.random() < 0.5, None if i % 9 == 0 else f"c{rnd.randrange(50)}",
             f"k{rnd.randrange(codes)}", f"u{rnd.randrange(4 * n)}", f"text {rnd.randrange(10 ** 9)}", None, i % 2) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("parts", [1, 4])
def test_states_of_increments_equal_the_profile_of_the_union(spark, tmp_path, parts):
    frames = [frame(spark, n, seed) for seed, n in enumerate([2000, 37, 3000, 1])]
    log = PS.state_log(spark, str(tmp_path / "states"))
    for i, f in enumerate(frames):
        assert PS.add_increment(log, f.repartition(parts), str(i)) and not PS.add_increment(log, f, str(i))
        if i == 1:
            log.compact(PS.merged)
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    want = {r["column"]: r for r in P.profile(union, round_stats=False).collect()}
    got = {r["column"]: r for r in PS.profile_of(log.read(), round_stats=False).collect()}
    assert set(got) == set(want)
    for c, w in want.items():
        g = got[c]
        assert [g[k] for k in EXACT] == [w[k] for k in EXACT], c
        for k, rel in (("mean", 1e-12), ("std", 1e-9)):
            assert g[k] == (w[k] if w[k] is None else pytest.approx(w[k], rel=rel)), c
        if g["n_unique_exact"]:
            assert g["n_unique"] == w["n_unique"], c
        else:
            assert w["n_unique"] > P.ID_LIKE_MIN_DISTINCT and abs(g["n_unique"] / w["n_unique"] - 1) < 0.04
    assert not got["user_id"]["n_unique_exact"] and got["code"]["n_unique_exact"]
    xs = sorted(r.x for r in union.where("x is not null").collect())
    below = sum(v <= got["x"]["median"] for v in xs) / len(xs)
    assert abs(below - 0.5) < 0.03
    tops = [(r["column"], r["value"], r["count"], r["rank"]) for r in PS.top_values_of(log.read()).collect()]
    assert sorted(tops) == sorted((r["column"], r["value"], r["count"], r["rank"]) for r in P.top_values(union, ["cat"]).collect())


@pytest.mark.parametrize("distinct", [49, 50, 51, 999, 1000, 1001, 1249, 1250, 1251, 1400, 5000])
def test_roles_at_the_thresholds(spark, distinct):
    rows = [(f"v{i}", f"v{i}", i % 2) for i in range(distinct)]
    halves = [spark.createDataFrame(rows[:2 * distinct // 3], "name string, name_id string, target int"),
              spark.createDataFrame(rows[distinct // 2:], "name string, name_id string, target int")]
    states = PS.column_states(halves[0]).unionByName(PS.column_states(halves[1]))
    want = {r["column"]: r["role"] for r in P.profile(halves[0].unionByName(halves[1])).collect()}
    prof = PS.profile_of(states).collect()
    assert {r["column"]: r["role"] for r in prof} == want
    assert all(r["n_unique"] == distinct for r in prof if r["n_unique_exact"])


def test_empty_and_all_null_increments(spark):
    df = spark.createDataFrame([(None, None, 1)], "x double, s string, target int")
    states = PS.column_states(df.limit(0)).unionByName(PS.column_states(df))
    got = {r["column"]: r for r in PS.profile_of(states).collect()}
    assert got["x"]["mean"] is None and got["x"]["median"] is None and got["x"]["null_pct"] == 100.0
    assert got["s"]["n_unique"] == 0 and got["s"]["role"] == "categorical"
    assert PS.profile_of(PS.column_states(df.limit(0))).count() == 2

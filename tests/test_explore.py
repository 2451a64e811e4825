"""Sketches, heavy hitters, reconciliation, JSON properties and step paths."""
import datetime as dt
import json
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickwell.operators import heavy, paths, props, reconcile as R, sketches
from clickwell.operators.temporal import micros

T0 = dt.datetime(2024, 1, 1)


# --- sketches -----------------------------------------------------------------------------

def test_merged_sketches_keep_their_bounds(spark):
    """Users overlap between days, so daily distinct counts do not add up; merged ones do."""
    rows = spark.range(200_000).select(
        F.expr("date_add(date '2024-01-01', cast(id % 10 as int))").alias("day"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.abs(F.hash("id")) % 30_000).alias("user"),
        (F.abs(F.hash("id", F.lit(1))) % 10_000 / 100).alias("v"))
    stored = sketches.daily_sketches(rows, "day", ["user"], ["v"]).persist()
    assert stored.count() == 10
    ranges = spark.createDataFrame([(dt.date(2024, 1, a), dt.date(2024, 1, b)) for a, b in ((1, 1), (2, 7), (1, 10))],
                                   "first date, last date")
    for r in sketches.roll_up(stored, ranges, ["user"], ["v"], (0.25, 0.5, 0.99)).collect():
        part = rows.filter(F.col("day").between(r.first, r.last))
        exact = part.select("user").distinct().count()
        assert abs(r.user_distinct - exact) <= sketches.DISTINCT_BOUND * exact and r.n_rows == part.count()
        for q, value in zip((0.25, 0.5, 0.99), r.v_quantiles):
            rank = part.filter(F.col("v") <= value).count() / r.n_rows
            below = part.filter(F.col("v") < value).count() / r.n_rows
            assert below - sketches.RANK_BOUND <= q <= rank + sketches.RANK_BOUND
    stored.unpersist()


def test_sketches_defined_cases(spark):
    rows = spark.createDataFrame([(None, 1, 1.0), (dt.date(2024, 1, 1), None, None)], "day date, user long, v double")
    stored = sketches.daily_sketches(rows, "day", ["user"], ["v"])
    ranges = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 2)), (dt.date(2020, 1, 1), dt.date(2020, 1, 2))], "first date, last date")
    got = sorted(sketches.roll_up(stored, ranges, ["user"], ["v"]).collect())
    assert [(r.n_rows, r.user_distinct, r.v_quantiles) for r in got] == [(0, 0, None), (1, 0, None)]


# --- heavy hitters ---------------------------------------------------------------------------

def exact_top(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("counters", [8, 64, 1024])
def test_heavy_hitters_are_exact(spark, counters):
    rng = random.Random(counters)
    skewed = [rng.choice(["hot"] * 30 + ["warm"] * 10 + [f"w{i}" for i in range(60)] + [None]) for _ in range(6000)]
    flat = [f"f{rng.randrange(300)}" for _ in range(6000)]
    df = spark.createDataFrame(list(zip(skewed, flat, [None] * 6000)), "a string, b string, c string").repartition(7)
    got = {}
    for r in heavy.heavy_hitters(df, ["a", "b", "c"], k=3, counters=counters).collect():
        got.setdefault(r["column"], []).append((r["rank"], r["value"], r["count"]))
    want = {c: [(i, v, n) for i, (v, n) in enumerate(exact_top(x, 3), 1)] for c, x in (("a", skewed), ("b", flat))}
    assert {c: sorted(x) for c, x in got.items()} == want


def test_summaries_understate_by_no_more_than_they_say(spark):
    rng = random.Random(1)
    values = [f"v{int(rng.paretovariate(0.8))}" for _ in range(30_000)]
    exact = Counter(values)
    rows = spark.createDataFrame([(v,) for v in values], "a string").repartition(5)
    told = heavy.summary(rows, ["a"], 32).toPandas()
    assert told.groupby(told.index // 33).size().max() <= 33 and len(told) <= 5 * 33       # bounded per task
    off = int(told["off"].sum())
    merged = told.dropna(subset=["value"]).groupby("value")["n"].sum()
    for v, n in exact.items():
        assert merged.get(v, 0) <= n <= merged.get(v, 0) + off
    assert off <= 30_000 / 33
    chosen = {r["value"]: r["bound"] for r in heavy.candidates(heavy.summary(rows, ["a"], 32), ["a"], 32).collect()}
    assert all(n <= min(chosen.values()) for v, n in exact.items() if v not in chosen)


def test_reduce_takes_the_next_largest_off():
    left, off = heavy._reduce(pd.Series({"a": 9, "b": 5, "c": 5, "d": 1}), 2)
    assert off == 5 and left.to_dict() == {"a": 4}
    with pytest.raises(ValueError):
        heavy.heavy_hitters(None, ["a"], k=9, counters=8)


# --- reconciliation ---------------------------------------------------------------------------

def test_differences_equal_except_all(spark):
    rng = random.Random(2)
    rows = lambda n: [(rng.choice([None, 1, 2, 3]), rng.choice([0.0, -0.0, float("nan"), 1.5]), rng.choice("ab")) for _ in range(n)]
    schema = "k int, `a.b` double, n_left string"
    a, b = spark.createDataFrame(rows(200), schema), spark.createDataFrame(rows(180), schema)
    same = lambda x, y: x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0
    assert same(R.except_all(a, b), a.exceptAll(b)) and same(R.except_all(b, a), b.exceptAll(a))
    assert same(R.intersect_all(a, b), a.intersectAll(b)) and R.intersect_all(a, b).count() > 50
    s = R.summary(a, b).first()
    assert (s.left_rows, s.right_rows) == (200, 180) and s.common == a.intersectAll(b).count()
    assert (s.only_left, s.only_right) == (a.exceptAll(b).count(), b.exceptAll(a).count())


def test_reconciliation_defined_cases(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    assert R.differences(a, a).count() == 0 and R.differences(a.limit(0), a.limit(0)).count() == 0
    assert R.summary(a.limit(0), a.limit(0)).first().common == 0
    got = R.differences(a, a.select("v", F.col("k").cast("long").alias("k")).distinct()).collect()
    assert [(r.k, r.v, r.n_left, r.n_right) for r in got] == [(1, "x", 2, 1)]
    assert R.differences(a, a.withColumn("v", F.lit("y")), ["k"]).count() == 0
    with pytest.raises(ValueError, match="z"):
        R.differences(a, a.withColumn("z", F.lit(1)))


def test_one_shuffle_of_counts(spark):
    a = spark.range(1000).selectExpr("id % 10 as k")
    plan = R.summary(a, a.filter("k <> 3"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan and "Join" not in plan


# --- properties ------------------------------------------------------------------------------

TEXTS = [None, "", "{", '{"a": 1', '{"a": 1}', '{"a": "x", "b": {"c": [1, {"d": null}], "e": {}}, "f": []}', "[1, [2]]", "7", "null",
         '{"a": true, "b": 1.25}', '{"b": {"c": ["z"]}}']


def brute_leaves(text):
    def walk(path, v):
        if isinstance(v, dict) and v:
            return [x for k, w in v.items() for x in walk(f"{path}.{k}", w)]
        if isinstance(v, list) and v:
            return [x for w in v for x in walk(f"{path}[*]", w)]
        return [] if isinstance(v, (dict, list)) else [(path, None if v is None else json.dumps(v).strip('"'))]
    try:
        return walk("$", json.loads(text))
    except (TypeError, ValueError):
        return []


def test_leaves_equal_brute_force(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id long, props string")
    got = Counter((r.id, r.path, r.value) for r in props.leaves(rows, "props", "id").collect())
    assert got == Counter((i, p, v) for i, t in enumerate(TEXTS) for p, v in brute_leaves(t))
    q = props.quality(rows, "props").first()
    assert (q.n_rows, q.n_null, q.n_malformed, q.n_objects, q.n_arrays, q.n_plain) == (11, 1, 3, 4, 1, 2)
    schema = props.discovered_schema(rows.filter("id in (4, 9)"), "props").first().schema
    assert "a: " in schema and "b: DECIMAL(3,2)" in schema
    assert props.profile(rows.limit(0), "props", "id").count() == 0


def test_depth_loses_nothing(spark):
    deep = '{"a": {"b": {"c": {"d": 1}}}, "x": 2}'
    rows = spark.createDataFrame([(1, deep)], "id long, props string")
    got = {(r.path, r.type, r.value) for r in props.leaves(rows, "props", "id", depth=2).collect()}
    assert got == {("$.x", "BIGINT", "2"), ("$.a.b", "NESTED", '{"c":{"d":1}}')}


def test_extract_parses_once_and_keeps_names(spark):
    rows = spark.createDataFrame([(1, '{"k": 5, "s": "x"}'), (2, "{"), (3, '{"k": "no"}')], "row long, props string")
    out = props.extract(rows, "props", {"k": ("$.k", "bigint"), "s": ("$.s", "string")})
    assert [tuple(r) for r in out.orderBy("row").collect()] == [(1, '{"k": 5, "s": "x"}', 5, "x"), (2, "{", None, None), (3, '{"k": "no"}', None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse") <= 2 and "Join" not in plan


def test_unnesting_is_narrow(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id long, props string")
    plan = props.leaves(rows, "props", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


# --- step paths --------------------------------------------------------------------------------

STEPS = ("view", "click", "buy")


def brute_attempts(rows, within):
    out, now, n = [], {}, Counter()

    def done(u):
        n[u] += 1
        out.append((u, n[u], len(now[u]), tuple(now[u])))
        now[u] = []

    for u, t, _, kind in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[3] in STEPS), key=lambda r: (r[0], r[1], r[2])):
        mine = now.setdefault(u, [])
        if mine and t - mine[0] > dt.timedelta(seconds=within):
            done(u)
        if kind == STEPS[len(now[u])]:
            now[u].append(t)
            if len(now[u]) == len(STEPS):
                done(u)
    for u in sorted(now):
        if now[u]:
            done(u)
    return sorted(out)


@pytest.mark.parametrize("within", [60, 3600, 10 ** 7])
def test_attempts_equal_brute_force(spark, within):
    rng = random.Random(within)
    rows = [(rng.choice([0, 0, 0, 1, 2, 3, None]), rng.choice([None] + [T0 + dt.timedelta(minutes=rng.randrange(5000))] * 30), i,
             rng.choice([*STEPS, "other", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_id long, event_type string").repartition(5)
    got = paths.match_steps(df, STEPS, within).collect()
    unix = lambda t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assert sorted((r.user_id, r.attempt, r.reached, tuple(r.times)) for r in got) == [
        (u, k, n, tuple(map(unix, t))) for u, k, n, t in brute_attempts(rows, within)]
    assert all(r.complete == (r.reached == 3) for r in got)


def test_paths_defined_cases(spark):
    none = spark.createDataFrame([], "user_id long, ts timestamp_ntz, event_id long, event_type string")
    assert paths.match_steps(none, STEPS, 60).count() == 0
    assert paths.step_counts(paths.match_steps(none, STEPS, 60), STEPS).count() == 0
    with pytest.raises(ValueError):
        paths.match_steps(none, (), 60)
    assert none.select(micros(none, "ts")).count() == 0

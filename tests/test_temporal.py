"""As-of and interval joins against brute force, and where a hot key's rows go."""
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from clickwell.operators import temporal as T

T0 = dt.datetime(2024, 3, 30, 22)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def tables(spark, rng, n_left, n_right, keys, span, kind="timestamp_ntz"):
    key = lambda: rng.choice([0] * keys + list(range(keys)) + [None])  # noqa: E731  key 0 has half of all rows
    time = lambda: None if rng.random() < 0.03 else at(rng.randrange(span))
    left = [(i, key(), time()) for i in range(n_left)]
    right = [(100_000 + i, key(), time(), rng.random()) for i in range(n_right)]
    return (left, right, spark.createDataFrame(left, f"id long, k int, t {kind}"),
            spark.createDataFrame(right, f"id long, k int, t {kind}, v double"))


@pytest.mark.parametrize("slices, equal, tolerance, kind", [(4, True, None, "timestamp_ntz"), (16, False, None, "timestamp"),
                                                            (8, True, 1800, "timestamp_ntz"), (64, False, 60, "timestamp_ntz")])
def test_asof_equals_brute_force(spark, slices, equal, tolerance, kind):
    left, right, a, b = tables(spark, random.Random(slices), 700, 500, 9, 600, kind)
    got = {r.id: r.last_id for r in T.asof_join(a, b, "k", "t", "t", tie=("id",), allow_equal=equal,
                                                tolerance_seconds=tolerance, slices=slices).collect()}
    assert len(got) == len(left)
    for i, k, t in left:
        found = [(rt, ri) for ri, rk, rt, _ in right if None not in (k, t, rt) and rk == k and (rt <= t if equal else rt < t)]
        best = max(found, default=None)
        if best and tolerance is not None and (t - best[0]).total_seconds() > tolerance:
            best = None
        assert got[i] == (best and best[1]), (i, k, t)


def test_asof_defined_cases(spark):
    schema = "id long, k int, t timestamp_ntz"
    one = spark.createDataFrame([(1, 1, at(5)), (1, 1, at(5)), (2, None, at(5)), (3, 1, None)], schema)
    none = spark.createDataFrame([], schema)
    assert sorted((r.id, r.last_id) for r in T.asof_join(one, one, "k", "t", "t", tie=("id",)).collect()) == [
        (1, 1), (1, 1), (2, None), (3, None)]
    assert T.asof_join(one, none, "k", "t", "t").filter("last_id is null").count() == 4
    assert T.asof_join(none, one, "k", "t", "t").count() == 0
    clash = one.withColumnsRenamed({"id": "slice"}).withColumn("bounds", F.lit(1))
    assert T.asof_join(clash, clash, "k", "t", "t").columns == ["slice", "k", "t", "bounds", "last_slice", "last_t", "last_bounds"]
    with pytest.raises(ValueError):
        T.asof_join(one, one.withColumn("t", F.col("t").cast("timestamp")), "k", "t", "t")


def test_no_task_holds_a_whole_hot_key(spark):
    """One key has all rows: its slices are about equal, each a group of its own, and the carried
    rows arrive by broadcast."""
    rows = spark.range(40_000).select(F.lit(1).alias("k"), F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("t"))
    bounds = T.hot_slices(rows.select("k", T.micros(rows, "t").alias("t")), 16).first()
    assert len(bounds.bounds) == 15
    sizes = [b - a for a, b in zip(bounds.bounds, bounds.bounds[1:])]
    assert max(sizes) < 2 * 40_000 / 16 * 1e6
    joined = T.asof_join(rows, rows.withColumn("v", F.lit(1)), "k", "t", "t", slices=16)
    assert joined.filter("last_t <> t").count() == 0 and joined.count() == 40_000
    joined.write.format("noop").mode("overwrite").save()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    windows = [k for k, x in enumerate(lines) if re.search(r"- (\*\(\d+\) )?Window ", x)]
    dealt = [next(x for x in lines[k:] if "Exchange hashpartitioning" in x) for k in windows]
    assert any("slice#" in x for x in dealt)      # the rows; only the carried rows, one a slice, are dealt by key alone
    assert all("slice#" in x or "start" in lines[k] or "end#" in lines[k] for k, x in zip(windows, dealt))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("strict, kind", [(False, "timestamp_ntz"), (True, "timestamp")])
def test_interval_join_equals_brute_force(spark, strict, kind):
    left, right, a, b = tables(spark, random.Random(3), 400, 400, 6, 900, kind)
    got = sorted((r.id, r.r_id) for r in T.interval_join(a, b, "k", "t", "t", 45 * 60, prefix="r_", strict=strict).collect())
    want = sorted((i, ri) for i, k, t in left for ri, rk, rt, _ in right if None not in (k, t, rt) and rk == k
                  and dt.timedelta(0) <= rt - t <= dt.timedelta(minutes=45) and (rt > t or not strict))
    assert got == want and len(want) > 500


def test_interval_join_plan(spark):
    left, right, a, b = tables(spark, random.Random(3), 50, 50, 6, 900)
    plan = T.interval_join(a, b, "k", "t", "t", 60, prefix="r_")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert re.search(r"(SortMergeJoin|HashJoin)[^\n]*bucket", plan)
    with pytest.raises(ValueError):
        T.interval_join(a, b, "k", "t", "t", 0)


def test_times_before_the_epoch(spark):
    rows = spark.createDataFrame([(1, 1, dt.datetime(1969, 12, 31, 23, 59, 59)), (2, 1, dt.datetime(1970, 1, 1))],
                                 "id long, k int, t timestamp_ntz")
    got = {(r.id, r.r_id) for r in T.interval_join(rows, rows, "k", "t", "t", 10, prefix="r_").collect()}
    assert got == {(1, 1), (1, 2), (2, 2)}
    assert [r.m for r in rows.select(T.micros(rows, "t").alias("m")).collect()] == [-1_000_000, 0]


def test_attribution_rules(spark):
    pairs = spark.createDataFrame([(1, 10, at(0), 30.0), (1, 11, at(5), 30.0), (1, 12, at(5), 30.0), (2, 12, at(5), 7.0)],
                                  "order_id long, event_id long, ts timestamp_ntz, amount double")
    credit = lambda rule: {r.event_id: (r.n_orders, r.credit) for r in T.attribute(
        pairs, "order_id", "event_id", "ts", "amount", rule).collect()}
    assert credit("first") == {10: (1, 30.0), 12: (1, 7.0)}
    assert credit("last") == {12: (2, 37.0)}
    assert credit("linear") == {10: (1, 10.0), 11: (1, 10.0), 12: (2, 17.0)}
    with pytest.raises(ValueError):
        T.attribute(pairs, "order_id", "event_id", "ts", "amount", "middle")

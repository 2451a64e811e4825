"""Joins on time: as-of, interval, and click attribution.

**As-of join.** Each left row takes the last right row of its key that is not later.  Both
sides are put under each other, sorted by time within their key, and the last right row
is carried forward: one shuffle, and no pair of rows is ever formed.  A key with more
than its share of the rows would fill one task, so the rows of such keys are dealt into
time slices.  There are at most ``slices`` such keys and 2 * ``slices`` slices whatever the size of
the data (a key is hot from 1 / ``slices`` of all rows on), so their bounds are
broadcast.  What a slice needs from the slices before it is one right row, found by one small
aggregation; rows of equal time stay in one slice.

**Interval join.** Left and right rows of one key pair up when the right row's time lies
within a window after the left row's.  Time is cut into buckets as long as the window; a
left row is copied to the buckets that its window touches (two at most), a right row
stays in its own, so the join is an equi-join on (key, bucket) with an exact
recheck.  Every pair meets in one bucket only.  A hot key is spread over its buckets; what is still
uneven is split by Spark's skew join.

Times are timestamps.  Defined cases: rows with a null key or time match nothing (left rows
are kept by the as-of join, dropped by the interval join); repeated rows are matched row
by row; of right rows with the same key and time the one with the largest ``tie`` columns is
the last; columns of both sides keep their names, right ones behind ``prefix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import write_shared

MICROS_PER_SECOND = 1_000_000


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds of a time: since the epoch, or of the wall clock where the column has no
    time zone (so the session's zone and its clock changes have no effect)."""
    c = F.col(f"`{ts}`")
    if df.schema[ts].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(c)
    day = F.unix_date(c.cast("date")).cast("long") * 86_400_000_000
    clock = F.hour(c).cast("long") * 3600 + F.minute(c) * 60
    return day + clock * MICROS_PER_SECOND + (F.extract(F.lit("SECOND"), c) * MICROS_PER_SECOND).cast("long")


def _one_kind(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str) -> None:
    kinds = {left.schema[left_ts].dataType.typeName(), right.schema[right_ts].dataType.typeName()}
    if len(kinds) > 1:
        raise ValueError(f"the times of both sides must be of one type, not {' and '.join(sorted(kinds))}")


def _struct(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def hot_slices(rows: DataFrame, slices: int) -> DataFrame:
    """(k, bounds): for every key that holds more than 1 / ``slices`` of the rows (k, t), the
    times that cut it into parts of about that share.  At most ``slices`` rows."""
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    hot = counts.join(F.broadcast(total), F.col("n") * slices > F.col("total")).select(
        "k", F.ceil(F.col("n") * slices / F.col("total")).cast("int").alias("parts"))
    # one percentile sketch a task and hot key, in steps of 1 / slices of the key's rows
    steps = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    grid = (rows.join(F.broadcast(hot), "k").groupBy("k", "parts")
            .agg(F.percentile_approx("t", steps, F.lit(slices * 100)).alias("grid")))
    return grid.select("k", F.array_sort(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("parts") - 1, F.lit(1))),
        lambda i: F.get("grid", F.greatest(F.least((i * slices / F.col("parts")).cast("int"), F.lit(slices - 1)) - 1, F.lit(0))))))
        .alias("bounds"))


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              tie: Sequence[str] = (), prefix: str = "last_", allow_equal: bool = True,
              tolerance_seconds: int | None = None, slices: int | None = None) -> DataFrame:
    """``left`` with the columns of the last right row of the same ``key`` whose time is not
    after the left row's (before it, without ``allow_equal``; not older than the tolerance), or
    nulls.  ``slices``: parts the hottest keys are cut to, by default the shuffle partitions."""
    _one_kind(left, right, left_ts, right_ts)
    spark = left.sparkSession
    slices = min(slices or int(spark.conf.get("spark.sql.shuffle.partitions")), 1000)
    slices = max(slices, 2)
    l_row, r_row = _struct(left), _struct(right)
    l_type, r_type = left.schema.simpleString(), right.schema.simpleString()
    late, early = (1, 0) if allow_equal else (0, 1)   # order of the sides at equal times
    nothing = lambda t: F.lit(None).cast(t)
    tie_type = F.struct(*[F.col(f"`{c}`") for c in tie]) if tie else F.lit(0)
    none_tie = nothing(right.select(tie_type.alias("x")).schema["x"].dataType)
    both = left.select(F.col(f"`{key}`").alias("k"), micros(left, left_ts).alias("t"), F.lit(late).alias("side"), none_tie.alias("tie"),
                       l_row.alias("l"), nothing(r_type).alias("r")).unionByName(
        right.select(F.col(f"`{key}`").alias("k"), micros(right, right_ts).alias("t"), F.lit(early).alias("side"), tie_type.alias("tie"),
                     nothing(l_type).alias("l"), r_row.alias("r")))
    timed = both.filter("k is not null and t is not null")
    bounds = write_shared(hot_slices(timed.select("k", "t"), slices))
    forward = Window.orderBy("t", "side", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.last(F.when(F.col("r").isNotNull(), F.struct("t", "r")), ignorenulls=True)
    if bounds.isEmpty():
        found = timed.withColumn("m", seen.over(forward.partitionBy("k"))).filter("l is not null")
    else:
        sliced = timed.join(F.broadcast(bounds), "k", "left").withColumn(
            "slice", F.coalesce(F.size(F.filter("bounds", lambda b: b < F.col("t"))), F.lit(0)))
        # what later slices of a hot key start from: the last right row of each slice
        ends = (sliced.filter("bounds is not null and r is not null").groupBy("k", "slice")
                .agg(F.max_by(F.struct("t", "r"), F.struct("t", "tie")).alias("end")))
        before = Window.partitionBy("k").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        grid = F.explode(F.sequence(F.lit(0), F.size("bounds"))).alias("slice")
        starts = (bounds.select("k", grid).join(ends, ["k", "slice"], "left")
                  .select("k", "slice", F.last("end", ignorenulls=True).over(before).alias("start")).filter("start is not null"))
        found = (sliced.withColumn("m", seen.over(forward.partitionBy("k", "slice"))).filter("l is not null")
                 .join(F.broadcast(starts), ["k", "slice"], "left").withColumn("m", F.coalesce("m", "start")))
    if tolerance_seconds is not None:
        found = found.withColumn("m", F.when(F.col("t") - F.col("m.t") <= tolerance_seconds * MICROS_PER_SECOND, F.col("m")))
    untimed = both.filter("l is not null and (k is null or t is null)").select("l", F.lit(None).cast(r_type).alias("r"))
    return found.select("l", "m.r").unionByName(untimed).select(
        *[F.col("l")[c].alias(c) for c in left.columns],
        *[F.col("r")[c].alias(prefix + c) for c in right.columns if c != key])


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  within_seconds: int, prefix: str = "", strict: bool = False) -> DataFrame:
    """Pairs of rows of one ``key`` with left time <= right time <= left time + window (``strict``:
    the right row must be later).  Columns of both sides; the right key is left out."""
    if within_seconds <= 0:
        raise ValueError("the window must be longer than nothing")
    _one_kind(left, right, left_ts, right_ts)
    width = within_seconds * MICROS_PER_SECOND
    bucket = lambda t: F.expr(f"({t}) div {width} - if(({t}) % {width} < 0, 1, 0)")  # floor
    start = left.select(F.col(f"`{key}`").alias("k"), micros(left, left_ts).alias("lt"), _struct(left).alias("l")).filter("k is not null and lt is not null")
    copies = start.select("*", F.explode(F.sequence(bucket("lt"), bucket(f"lt + {width}"))).alias("bucket"))
    ends = right.select(F.col(f"`{key}`").alias("k"), micros(right, right_ts).alias("rt"), _struct(right).alias("r")).filter(
        "k is not null and rt is not null").withColumn("bucket", bucket("rt"))
    in_time = (F.col("rt") > F.col("lt") if strict else F.col("rt") >= F.col("lt")) & (F.col("rt") <= F.col("lt") + F.lit(width))
    return copies.join(ends, ["k", "bucket"]).filter(in_time).select(
        *[F.col("l")[c].alias(c) for c in left.columns],
        *[F.col("r")[c].alias(prefix + c) for c in right.columns if c != key])


ATTRIBUTION = ("first", "last", "linear")


def attribute(pairs: DataFrame, order_id: str, touch_id: str, touch_ts: str, amount: str, rule: str) -> DataFrame:
    """Credit for each touch from (touch, order) pairs: per touch the orders it has a share in and
    the amount credited.  ``first`` / ``last``: the order's whole amount to its first or last touch
    (ties: smallest or largest touch id); ``linear``: equal shares.  Amounts are summed as
    decimals, so the result does not depend on the order of rows."""
    if rule not in ATTRIBUTION:
        raise ValueError(f"unknown attribution rule {rule!r}")
    money = F.col(f"`{amount}`").cast("decimal(18,2)")
    touch = F.struct(F.col(f"`{touch_ts}`").alias("ts"), F.col(f"`{touch_id}`").alias("id"))
    if rule == "linear":
        n = pairs.groupBy(F.col(f"`{order_id}`").alias("o")).agg(F.count(F.lit(1)).alias("n"))
        credit = pairs.select(F.col(f"`{order_id}`").alias("o"), F.col(f"`{touch_id}`").alias("touch"), money.alias("amount")).join(n, "o").select(
            "touch", (F.col("amount") / F.col("n")).cast("decimal(28,10)").alias("credit"))
    else:
        pick = F.min if rule == "first" else F.max
        credit = pairs.groupBy(F.col(f"`{order_id}`").alias("o")).agg(pick(touch).alias("touch"), F.max(money).alias("amount")).select(
            "touch.id", F.col("amount").cast("decimal(28,10)").alias("credit")).withColumnRenamed("id", "touch")
    return credit.groupBy(F.col("touch").alias(touch_id)).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("credit").cast("double").alias("credit"))

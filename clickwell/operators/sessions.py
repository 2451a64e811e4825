"""Sessions: runs of a user's events with no pause longer than ``gap``.

A session is an interval with measures that add up (events, clicks, value), so sessions
of parts of the log can be put together again: intervals of one user that are at most
``gap`` apart are one session, whatever they were made of.  ``merge`` does that; an event is an interval
of no length.  Merging all events at once, or in any parts and any order, gives the same sessions,
which is what the stream (``streaming.sessions``) and the repair of late events build on.

A user with a large share of the log is not sorted in one task: intervals are first merged
within (user, time slice), then the results per user.  The second step sees one interval
per session and slice, so its size follows the span of time, not the number of events.

Defined cases: rows with a null user or time are left out; repeated events count as
often as they are there; no rows give no sessions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .temporal import MICROS_PER_SECOND, micros

#: slices of the first step, in gaps; any number gives the same sessions
SLICE_GAPS = 48
COLUMNS = ("user_id", "session_start", "session_end", "n_events", "n_clicks", "value")


def as_intervals(events: DataFrame, user: str = "user_id", ts: str = "ts", kind: str = "event_type", value: str = "value") -> DataFrame:
    """One interval of no length per event; money is decimal, so sums do not depend on order."""
    return events.select(
        F.col(f"`{user}`").alias("user_id"), F.col(f"`{ts}`").alias("session_start"), F.col(f"`{ts}`").alias("session_end"),
        F.lit(1).cast("long").alias("n_events"),
        F.when(F.col(f"`{kind}`") == "click", 1).otherwise(0).cast("long").alias("n_clicks"),
        F.coalesce(F.col(f"`{value}`").cast("decimal(28,2)"), F.lit(0).cast("decimal(28,2)")).alias("value")
    ).filter("user_id is not null and session_start is not null")


def _merge_within(intervals: DataFrame, keys: list[str], gap: Column) -> DataFrame:
    """Merge the intervals of each group of ``keys``: a session starts where the latest end so
    far is more than ``gap`` before the next start."""
    order = Window.partitionBy(*keys).orderBy("session_start", "session_end")
    before = F.max("session_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col("session_start") > before + gap), 1).otherwise(0)
    numbered = intervals.withColumn("starts", starts).withColumn(
        "number", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*keys, "number").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        F.sum("n_events").alias("n_events"), F.sum("n_clicks").alias("n_clicks"),
        F.sum("value").cast("decimal(28,2)").alias("value")).drop("number")


def merge(intervals: DataFrame, gap_seconds: int) -> DataFrame:
    """The sessions that a table of intervals (``COLUMNS``) makes up."""
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    width = SLICE_GAPS * gap_seconds * MICROS_PER_SECOND
    sliced = intervals.select(*COLUMNS, F.floor(micros(intervals, "session_start") / width).alias("slice"))
    parts = _merge_within(sliced, ["user_id", "slice"], gap)
    return _merge_within(parts.select(*COLUMNS), ["user_id"], gap).select(*COLUMNS)


def sessions(events: DataFrame, gap_seconds: int) -> DataFrame:
    """The sessions of a whole log of events."""
    return merge(as_intervals(events), gap_seconds)


def repair(made: DataFrame, late: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions after late intervals are folded in.  Only the users with late intervals are merged
    again; the sessions of all others pass through."""
    users = late.select("user_id").distinct()
    again = made.join(users, "user_id", "left_semi").select(*COLUMNS).unionByName(late.select(*COLUMNS))
    return made.join(users, "user_id", "left_anti").select(*COLUMNS).unionByName(merge(again, gap_seconds))

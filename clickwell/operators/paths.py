"""Ordered step matching: how far each user gets along a path of events, in order.

A table function (UDTF) reads each user's events in time order, as Arrow batches, and walks
the steps: an event of the next step moves the user on, any other is passed over.  When the
last step is reached, or ``within`` seconds after the first one, the attempt is returned with
the times of the steps it got to, and the next attempt may begin.  Partial attempts are
returned too.

Spark partitions and sorts the events by user and time (one shuffle, spilled to disk where it must) and
hands them over batch by batch; what the function keeps is one attempt, a few numbers,
however many events a user has.

Defined cases: events with a null user or time are left out; repeated events are read one
after the other, ties in time by event id; types outside the steps are passed over; no events, no
attempts.  An event that is the first step of a running attempt does not begin another one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udtf

from .temporal import MICROS_PER_SECOND, micros

COLUMNS = ("user_id", "t", "event_id", "kind")
RESULT = "user_id bigint, attempt int, reached int, complete boolean, times array<bigint>"
_SCHEMA = pa.schema([("user_id", pa.int64()), ("attempt", pa.int32()), ("reached", pa.int32()), ("complete", pa.bool_()),
                     ("times", pa.list_(pa.int64()))])


def _matcher(steps: Sequence[str], within: int):
    steps = tuple(steps)

    @arrow_udtf(returnType=RESULT)
    class Match:
        def __init__(self):
            self.user, self.times, self.attempt = None, [], 0

        def _done(self, out: list) -> None:
            self.attempt += 1
            out.append({"user_id": self.user, "attempt": self.attempt, "reached": len(self.times),
                        "complete": len(self.times) == len(steps), "times": self.times})
            self.times = []

        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            out: list[dict] = []
            for user, t, kind in zip(*(rows.column(c).to_pylist() for c in ("user_id", "t", "kind"))):
                self.user = user
                if self.times and t - self.times[0] > within:
                    self._done(out)
                if kind == steps[len(self.times)]:
                    self.times.append(t)
                    if len(self.times) == len(steps):
                        self._done(out)
            yield pa.Table.from_pylist(out, schema=_SCHEMA)

        def terminate(self) -> Iterator[pa.Table]:
            out: list[dict] = []
            if self.times:
                self._done(out)
            yield pa.Table.from_pylist(out, schema=_SCHEMA)

    return Match


def match_steps(events: DataFrame, steps: Sequence[str], within_seconds: int, user: str = "user_id", ts: str = "ts",
                event_id: str = "event_id", kind: str = "event_type") -> DataFrame:
    """Every attempt of every user: ``attempt`` (from 1), ``reached`` (steps), ``complete`` and ``times``
    (microseconds of the steps reached)."""
    if not steps:
        raise ValueError("no steps to match")
    wanted = events.select(F.col(f"`{user}`").cast("bigint").alias("user_id"), micros(events, ts).alias("t"),
                           F.col(f"`{event_id}`").alias("event_id"), F.col(f"`{kind}`").alias("kind")).filter(
        F.col("user_id").isNotNull() & F.col("t").isNotNull() & F.col("kind").isin(*steps))
    match = _matcher(steps, within_seconds * MICROS_PER_SECOND)
    return match(wanted.asTable().partitionBy("user_id").orderBy("t", "event_id"))


def step_counts(attempts: DataFrame, steps: Sequence[str]) -> DataFrame:
    """Per step: attempts that reached it, and seconds from the first step (mean)."""
    each = attempts.select(F.posexplode("times").alias("at", "t"), F.get("times", F.lit(0)).alias("first"))
    names = F.array(*[F.lit(s) for s in steps])
    return each.groupBy("at").agg(F.count(F.lit(1)).alias("n_attempts"), F.sum(F.col("t") - F.col("first")).alias("micros")).select(
        (F.col("at") + 1).alias("step"), F.get(names, F.col("at")).alias("event_type"), "n_attempts",
        F.round(F.col("micros") / F.col("n_attempts") / MICROS_PER_SECOND, 3).alias("mean_seconds"))

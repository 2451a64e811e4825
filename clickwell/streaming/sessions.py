"""Sessions of a log that keeps arriving, with late events kept and folded in afterwards.

Spark's own session windows drop what comes after the watermark.  Here each micro-batch
splits its events by the watermark (the latest time of the batches before it, less
``delay``):

* events in time are merged with the open sessions of the batch before; sessions that
  ended more than ``gap`` before the new watermark are closed, the others stay open;
* late events go to a side table, as they are.

The state is the table of open sessions, written per batch: its size follows the users
active within gap + delay, and merging it is a shuffle by user with no unbounded group
(``operators.sessions``).  Every batch writes to folders of its own number and reads those of the
number before, so a batch that is repeated after a failure writes the same rows again.
An event in time can never touch a closed session, since it is not older than the watermark;
so closed, open and late rows together hold every event once, and ``reconcile`` gives
exactly the sessions of the whole log.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import sessions as S
from ..sources.sinks import delete_path, path_exists


def _folder(base: str, part: str, batch: int) -> str:
    return f"{base.rstrip('/')}/{part}/batch={batch}"


def _mark(spark: SparkSession, base: str, batch: int) -> dict | None:
    """What batch ``batch`` has left: its watermark (text of a time) and the batch that holds
    the open sessions."""
    path = _folder(base, "mark", batch)
    if batch < 0 or not path_exists(spark, path):
        return None
    return json.loads(spark.read.text(path).first()[0])


def _step(base: str, gap_seconds: int, delay_seconds: int):
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    delay = F.make_dt_interval(secs=F.lit(delay_seconds))

    def run(events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        kind = events.schema["ts"].dataType.simpleString()
        last = _mark(spark, base, batch - 1)
        rows = S.as_intervals(events).persist()
        latest = rows.agg(F.max("session_end").cast("string").alias("t")).first().t
        mark = max((x for x in (latest, last and last["latest"]) if x), default=None)   # ISO text sorts as time
        at = lambda t: F.lit(t).cast(kind) - delay
        is_late = F.col("session_start") < at(last["latest"]) if last and last["latest"] else F.lit(False)
        rows.filter(is_late).write.mode("overwrite").parquet(_folder(base, "late", batch))
        now = rows.filter(~is_late)
        if last:
            now = now.unionByName(spark.read.schema(now.schema).parquet(_folder(base, "open", batch - 1)))
        merged = S.merge(now, gap_seconds).persist()
        closed = F.col("session_end") + gap < at(mark) if mark else F.lit(False)
        merged.filter(closed).write.mode("overwrite").parquet(_folder(base, "closed", batch))
        merged.filter(~closed).write.mode("overwrite").parquet(_folder(base, "open", batch))
        spark.createDataFrame([(json.dumps({"latest": mark}),)], "value string").coalesce(1).write.mode("overwrite").text(
            _folder(base, "mark", batch))
        merged.unpersist()
        rows.unpersist()
        if batch >= 2:   # the batch before is still needed if this one is repeated
            delete_path(spark, _folder(base, "open", batch - 2))

    return run


def start_sessions(events: DataFrame, base: str, checkpoint: str, gap_seconds: int, delay_seconds: int,
                   available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``events`` is a streaming frame (user_id, ts, event_type, value)."""
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(_step(base, gap_seconds, delay_seconds))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def _read(spark: SparkSession, base: str, part: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{part}").select(*S.COLUMNS)


def closed_sessions(spark: SparkSession, base: str) -> DataFrame:
    """What the stream has finished so far, late events not counted."""
    return _read(spark, base, "closed")


def late_events(spark: SparkSession, base: str) -> DataFrame:
    """The side table: one interval of no length per late event."""
    return _read(spark, base, "late")


def open_sessions(spark: SparkSession, base: str) -> DataFrame:
    """The sessions that the newest batch left open."""
    marks = spark.read.text(f"{base.rstrip('/')}/mark").agg(F.max("batch").alias("b")).first().b
    return spark.read.parquet(_folder(base, "open", marks)).select(*S.COLUMNS)


def reconcile(spark: SparkSession, base: str, gap_seconds: int) -> DataFrame:
    """The sessions of everything that has arrived: closed and open ones with the late events
    folded in.  Users without late events are not touched."""
    made = closed_sessions(spark, base).unionByName(open_sessions(spark, base))
    return S.repair(made, late_events(spark, base), gap_seconds)

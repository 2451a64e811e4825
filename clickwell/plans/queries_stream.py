"""Registered queries of the streams: each writes the given tables to a folder in parts, runs
the stream over the parts, restarted for every part, and returns what it has written."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sessions as S
from ..session import new_folder
from ..sources.adapters import arrivals, touches
from ..streaming import conversions, sessions as stream
from .queries_time import _ORDERS, WINDOW
from .registry import register

#: pause that ends a session, and how far back the stream waits for events
GAP, DELAY = 6 * 3600, 2 * 3600
#: parts in which the events arrive: by thirds of the month; every twentieth comes last
_PART = "CASE WHEN event_id % 20 = 3 THEN 3 ELSE least((day(ts) - 1) // 10, 2) END"

_SESSIONS = f"""m AS (
  SELECT *, CASE WHEN ts <= lag(ts) OVER w + to_seconds({GAP}) THEN 0 ELSE 1 END AS s FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number FROM m)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
       count(*) FILTER (event_type = 'click') AS n_clicks, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS value
FROM n GROUP BY user_id, number"""


def _plain(sessions):
    return sessions.withColumn("value", F.col("value").cast("double"))


@register("sessions", f"WITH {_SESSIONS}")
def sessions(spark, sf):
    """Sessions of the whole log at once."""
    return _plain(S.sessions(touches(spark, sf), GAP))


def _streamed(spark, sf) -> str:
    """Run the session stream over the log in four parts; the folder it has written."""
    rows = touches(spark, sf).selectExpr(
        "*", "CASE WHEN event_id % 20 = 3 THEN 3 ELSE least((day(ts) - 1) div 10, 2) END AS part")
    raw, base, checkpoint = (new_folder(spark, x) for x in ("arrived", "sessions", "checkpoint"))
    for part in range(4):
        rows.filter(F.col("part") == part).drop("part").write.mode("append").parquet(raw)
        arriving = spark.readStream.schema(rows.drop("part").schema).parquet(raw)
        stream.start_sessions(arriving, base, checkpoint, GAP, DELAY).awaitTermination()
    return base


@register("sessions_streamed", f"WITH {_SESSIONS}")
def sessions_streamed(spark, sf):
    """Sessions made by the stream, with the late events folded in: those of the whole log."""
    return _plain(stream.reconcile(spark, _streamed(spark, sf), GAP))


@register("sessions_late", f"""WITH p AS (SELECT *, {_PART} AS part FROM events),
seen AS (SELECT part, max(ts) AS latest FROM p GROUP BY part),
mark AS (SELECT part, max(latest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM seen)
SELECT user_id, ts, count(*) AS n_events FROM p JOIN mark USING (part)
WHERE ts < latest - to_seconds({DELAY}) GROUP BY user_id, ts""")
def sessions_late(spark, sf):
    """The stream's side table: the events that came after the watermark had passed them."""
    late = stream.late_events(spark, _streamed(spark, sf))
    return late.groupBy("user_id", F.col("session_start").alias("ts")).agg(F.sum("n_events").alias("n_events"))


@register("orders_credited_stream", f"""WITH {_ORDERS},
c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
mark AS (SELECT greatest((SELECT max(ts) FROM c), (SELECT max(order_ts) FROM o)) - to_seconds({DELAY}) AS t),
p AS (SELECT o.order_id, c.event_id, c.ts FROM c JOIN o ON o.user_id = c.user_id AND o.order_ts >= c.ts
      AND o.order_ts <= c.ts + to_seconds({WINDOW})),
n AS (SELECT order_id, count(*) AS n_clicks, arg_max(event_id, ts) AS last_click_id FROM p GROUP BY order_id)
SELECT o.user_id, o.order_id, epoch_us(o.order_ts) AS ts_micros, o.amount, coalesce(n_clicks, 0) AS n_clicks, last_click_id
FROM o LEFT JOIN n USING (order_id), mark WHERE epoch_ms(o.order_ts) < epoch_ms(mark.t)""")
def orders_credited_stream(spark, sf):
    """Orders credited to clicks by the stateful stream, restarted for each ten days; orders
    within the delay of the newest time still wait."""
    rows = arrivals(spark, sf)
    raw, out, checkpoint = (new_folder(spark, x) for x in ("arrived", "credited", "checkpoint"))
    third = F.least(F.floor((F.day("ts") - 1) / 10), F.lit(2))
    for part in range(3):
        rows.filter(third == part).write.mode("append").parquet(raw)
        arriving = spark.readStream.schema(rows.schema).parquet(raw)
        conversions.start_credits(arriving, out, checkpoint, WINDOW, DELAY).awaitTermination()
    return spark.read.schema(conversions.OUTPUT).parquet(out)

"""Registered queries of the time operators: as-of and interval joins, attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import temporal
from ..sources.adapters import orders_on_log, touches
from .registry import register

#: how long after a click an order counts as its effect
WINDOW = 24 * 3600

_ORDERS = """o AS (
  SELECT o_orderkey AS order_id, o_custkey // 10 AS user_id,
         TIMESTAMP '2024-01-01' + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER))
           + to_seconds((o_orderkey * 7919) % 86400) AS order_ts, o_totalprice AS amount FROM orders)"""
_CLICKS = "c AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'click')"
_PAIRS = f"""{_ORDERS}, {_CLICKS},
p AS (SELECT c.event_id, c.user_id, c.ts, c.value, o.order_id, o.order_ts, o.amount
      FROM c JOIN o ON o.user_id = c.user_id AND o.order_ts >= c.ts AND o.order_ts <= c.ts + to_seconds({WINDOW}))"""


# --- as-of join --------------------------------------------------------------------------

@register("asof_last_event", f"""WITH {_ORDERS}
SELECT o.order_id, o.user_id, o.order_ts, o.amount, e.event_id AS last_event_id, e.ts AS last_ts,
       e.event_type AS last_event_type, e.value AS last_value
FROM o ASOF LEFT JOIN events e ON o.user_id = e.user_id AND o.order_ts >= e.ts""")
def asof_last_event(spark, sf):
    """Every order with the last event of its user before it."""
    return temporal.asof_join(orders_on_log(spark, sf), touches(spark, sf), "user_id", "order_ts", "ts", tie=("event_id",))


@register("asof_recent_click", f"""WITH {_ORDERS}, {_CLICKS}
SELECT o.order_id, o.user_id, o.order_ts, o.amount, c.event_id AS click_event_id, c.ts AS click_ts, c.value AS click_value
FROM o ASOF LEFT JOIN c ON o.user_id = c.user_id AND o.order_ts > c.ts
WHERE c.ts IS NULL OR o.order_ts - c.ts <= to_seconds({WINDOW})
UNION ALL
SELECT o.order_id, o.user_id, o.order_ts, o.amount, NULL, NULL, NULL
FROM o ASOF JOIN c ON o.user_id = c.user_id AND o.order_ts > c.ts
WHERE o.order_ts - c.ts > to_seconds({WINDOW})""")
def asof_recent_click(spark, sf):
    """Every order with the last click strictly before it, if that is at most a day old."""
    clicks = touches(spark, sf).filter("event_type = 'click'").drop("event_type")
    return temporal.asof_join(orders_on_log(spark, sf), clicks, "user_id", "order_ts", "ts", tie=("event_id",), prefix="click_",
                              allow_equal=False, tolerance_seconds=WINDOW)


# --- interval join and attribution ------------------------------------------------------------

def _pairs(spark, sf):
    clicks = touches(spark, sf).filter("event_type = 'click'").drop("event_type")
    return temporal.interval_join(clicks, orders_on_log(spark, sf), "user_id", "ts", "order_ts", WINDOW)


@register("orders_after_click", f"WITH {_PAIRS} SELECT * FROM p")
def orders_after_click(spark, sf):
    """All (click, order) pairs with the order at most a day after the click."""
    return _pairs(spark, sf)


def _credit(order: str) -> str:
    return f"""WITH {_PAIRS},
r AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {order}) AS k FROM p)
SELECT event_id, count(*) AS n_orders, CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS credit
FROM r WHERE k = 1 GROUP BY event_id"""


@register("attribution_first", _credit("ts, event_id"))
def attribution_first(spark, sf):
    return temporal.attribute(_pairs(spark, sf), "order_id", "event_id", "ts", "amount", "first")


@register("attribution_last", _credit("ts DESC, event_id DESC"))
def attribution_last(spark, sf):
    return temporal.attribute(_pairs(spark, sf), "order_id", "event_id", "ts", "amount", "last")


@register("attribution_linear", f"""WITH {_PAIRS},
n AS (SELECT order_id, count(*) AS n FROM p GROUP BY order_id)
SELECT event_id, count(*) AS n_orders, round(sum(amount / n), 6) AS credit FROM p JOIN n USING (order_id) GROUP BY event_id""")
def attribution_linear(spark, sf):
    """Equal shares; credit to six places."""
    return temporal.attribute(_pairs(spark, sf), "order_id", "event_id", "ts", "amount", "linear").withColumn(
        "credit", F.round("credit", 6))

"""Orders credited to clicks, per user, as both keep arriving (``transformWithState``).

Users are dealt to ``groups`` groups by a hash, and a group is one key of the state: every call
and every read or write of state passes between Spark and Python, so a call per user and batch
would cost far more than the work on its rows.  State per group: the clicks of the last ``within``
seconds and the orders that wait for the watermark, each a list of packed pieces of many rows.  An
order waits until the watermark has passed its time, so clicks that arrive after it in any batch,
but in time, still count; then it is emitted with the number of its user's clicks in its window and
the last of them.  Each group has one timer, at the first waiting order or else where the last
click leaves the window, so a batch costs one call per group it wakes, and the state of users who
come no more is cleared too: a group without clicks in the window and waiting orders leaves no state.

Spark drops what arrives behind the watermark (``delay``).  Orders within ``delay`` of the
newest time wait in the state and are emitted when the stream goes on.  State and source
offsets live in the checkpoint, so a restarted query goes on where it was; ``groups`` has to stay
the same for it.  Clicks and orders are rows of one stream; a group's rows of one batch reach the
state in Arrow batches.  A worker holds one group at a time, that is the share ``1 / groups`` of
the rows within window and delay, and all of a hot user's.  A woken group reads its whole state, so
a stream with short triggers and a long window wants more groups than one that catches up in few
large batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: the stream's columns: ``kind`` is click or order, ``amount`` is null for clicks
INPUT = "user_id bigint, ts timestamp, kind string, id bigint, amount double"
OUTPUT = "user_id bigint, order_id bigint, ts_micros bigint, amount double, n_clicks bigint, last_click_id bigint"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: groups that users are dealt to; fixed for the life of a checkpoint
GROUPS = 1024
#: a click or an order in the state; ``known`` is 0 where the id is null
_ROW = np.dtype([("user", "<i8"), ("ts", "<i8"), ("known", "<i1"), ("id", "<i8"), ("amount", "<f8")])
#: rows of one piece of a list
_PIECE = 1 << 14


class CreditOrders(StatefulProcessor):
    """Emits each order once the watermark has passed it."""

    def __init__(self, within_seconds: int):
        self.within = within_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clicks = handle.getListState("clicks", "rows binary")
        self.waiting = handle.getListState("waiting", "rows binary")
        self.timer = handle.getValueState("timer", "ms bigint")

    def _wake(self, ms: int) -> None:
        """Set the group's one timer to ``ms`` if that is earlier."""
        now = self.timer.get()
        if now is None or ms < now[0]:
            if now is not None:
                self.handle.deleteTimer(now[0])
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first_order, last_click = None, None
        for batch in rows:
            packed = np.zeros(len(batch), _ROW)
            for name in ("user", "ts", "known", "id", "amount"):
                packed[name] = batch["micros" if name == "ts" else name].to_numpy()
            ordered = batch["ordered"].to_numpy()
            clicks, orders = packed[~ordered], packed[ordered]
            if len(clicks):
                self.clicks.appendList(_pieces(clicks))
                last_click = max(last_click or 0, int(clicks["ts"].max()))
            if len(orders):
                self.waiting.appendList(_pieces(orders))
                first_order = min(first_order or int(orders["ts"].min()), int(orders["ts"].min()))
        if first_order is not None:
            self._wake(first_order // 1000 + 1)
        elif last_click is not None and self.timer.get() is None:
            self._wake((last_click + self.within) // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, clicks = _rows(self.waiting), _rows(self.clicks)
        due, left = waiting[waiting["ts"] < mark], waiting[waiting["ts"] >= mark]
        kept = clicks[clicks["ts"] >= mark - self.within]
        self._put(self.waiting, left, len(due) > 0)
        self._put(self.clicks, kept, len(kept) < len(clicks))
        if len(left):
            self._wake(int(left["ts"].min()) // 1000 + 1)
        elif len(kept):
            self._wake((int(kept["ts"].max()) + self.within) // 1000 + 1)
        if len(due):
            yield _credit(due, clicks, self.within)

    @staticmethod
    def _put(state, rows: np.ndarray, changed: bool) -> None:
        if changed and len(rows):
            state.put(_pieces(rows))
        elif changed:
            state.clear()

    def close(self) -> None:
        pass


def _pieces(rows: np.ndarray) -> list[tuple[bytes]]:
    return [(rows[i:i + _PIECE].tobytes(),) for i in range(0, len(rows), _PIECE)]


def _rows(state) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x[0]) for x in state.get()), _ROW)


def _credit(orders: np.ndarray, clicks: np.ndarray, within: int) -> pd.DataFrame:
    """Each order with its user's clicks of the ``within`` microseconds up to it: their number and
    the last one (of equal times the largest id)."""
    n = len(clicks)
    users, user = np.unique(np.concatenate([clicks["user"], orders["user"]]), return_inverse=True)
    times, time = np.unique(np.concatenate([clicks["ts"], orders["ts"], orders["ts"] - within]), return_inverse=True)
    at = user[:n] * len(times) + time[:n]  # clicks in order of user and time, as one number
    order = np.lexsort((clicks["id"], clicks["known"], at))
    at, clicks = at[order], clicks[order]
    base = user[n:] * len(times)
    first = np.searchsorted(at, base + time[n + len(orders):], "left")
    last = np.searchsorted(at, base + time[n:n + len(orders)], "right")
    found = last > first
    latest = np.zeros(len(orders), _ROW)
    latest[found] = clicks[last[found] - 1]
    return pd.DataFrame({
        "user_id": orders["user"], "order_id": pd.array(orders["id"], "Int64"), "ts_micros": orders["ts"],
        "amount": orders["amount"], "n_clicks": last - first, "last_click_id": pd.array(latest["id"], "Int64"),
    }).assign(order_id=lambda x: x["order_id"].mask(orders["known"] == 0),
              last_click_id=lambda x: x["last_click_id"].mask(latest["known"] == 0))


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store that list state and timers need, for the queries that start inside."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def credited(stream: DataFrame, within_seconds: int, delay_seconds: int, groups: int = GROUPS) -> DataFrame:
    """The streaming frame of credited orders; ``stream`` has the columns ``INPUT``.  Rows with a
    null user or time are left out."""
    timed = stream.filter("user_id is not null and ts is not null").withWatermark("ts", f"{delay_seconds} seconds")
    dealt = timed.filter("kind in ('click', 'order')").select(
        F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int").alias("users"), "ts", F.unix_micros("ts").alias("micros"),
        F.col("user_id").alias("user"), (F.col("kind") == "order").alias("ordered"),
        F.col("id").isNotNull().cast("tinyint").alias("known"), F.coalesce("id", F.lit(0).cast("long")).alias("id"), "amount")
    return dealt.groupBy("users").transformWithStateInPandas(
        CreditOrders(within_seconds), OUTPUT, outputMode="Append", timeMode="EventTime")


def start_credits(stream: DataFrame, out: str, checkpoint: str, within_seconds: int, delay_seconds: int,
                  available_now: bool = True, groups: int = GROUPS) -> StreamingQuery:
    """Append credited orders to the Parquet table ``out``."""
    with rocksdb(stream.sparkSession):
        writer = (credited(stream, within_seconds, delay_seconds, groups).writeStream.outputMode("append").format("parquet")
                  .option("checkpointLocation", checkpoint).option("path", out))
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def credited_batch(rows: DataFrame, within_seconds: int) -> DataFrame:
    """The same over a whole table at once: what the stream must add up to."""
    from ..operators.temporal import interval_join
    clicks = rows.filter("kind = 'click'").select("user_id", "ts", F.col("id").alias("click_id"))
    orders = rows.filter("kind = 'order' and user_id is not null and ts is not null").select(
        "user_id", F.col("ts").alias("order_ts"), F.col("id").alias("order_id"), "amount")
    pairs = interval_join(clicks, orders.select("user_id", "order_ts", "order_id"), "user_id", "ts", "order_ts", within_seconds)
    counted = pairs.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_clicks"),
                                            F.max(F.struct("ts", "click_id")).alias("last"))
    return orders.join(counted, "order_id", "left").select(
        "user_id", "order_id", F.unix_micros("order_ts").alias("ts_micros"), "amount",
        F.coalesce("n_clicks", F.lit(0).cast("long")).alias("n_clicks"), F.col("last.click_id").alias("last_click_id"))

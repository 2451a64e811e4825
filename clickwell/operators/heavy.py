"""Exact heavy hitters in two passes over the log.

Pass 1: every task keeps at most ``counters`` counters per column (Misra and Gries): when there
are more values, the next largest count is taken off all of them and what is left at zero
goes.  A task's summary understates a value by no more than what was taken off, and summaries
add up (Agarwal et al., "Mergeable Summaries", 2012).  The largest merged counters are the
candidates, and every other value is proven to have at most ``bound`` rows.

Pass 2: the candidates (at most ``counters`` a column, so they are broadcast) are counted
exactly.  If the k-th of them has more rows than the bound, no other value can be among the top
k.  A column whose k-th candidate does not clear the bound (many values about equally
frequent) is counted in full instead, with a ranking in two stages, so that no
column's values meet in one task.

Either way the counts are exact.  The summaries shuffle at most ``counters`` rows a task and column,
whatever the number of values; a hot value is one counter a task.

Defined cases: nulls are not counted; values are compared and returned as text; ties are
ordered by the value; a column without values has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import write_shared

COUNTERS = 1024


def _reduce(counts: pd.Series, counters: int) -> tuple[pd.Series, int]:
    """At most ``counters`` counters, and what was taken off each."""
    if len(counts) <= counters:
        return counts, 0
    largest = counts.nlargest(counters + 1)
    off = int(largest.iloc[-1])
    left = counts[counts > off] - off
    return left, off


def _summaries(columns: Sequence[str], counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: (pd.Series(dtype="int64"), 0) for c in columns}
        for batch in batches:
            for c in columns:
                seen = pc.value_counts(batch.column(c).drop_null())
                add = pd.Series(seen.field("counts").to_numpy(), index=seen.field("values").to_pandas(), dtype="int64")
                counts, off = held[c]
                counts = add if counts.empty else counts.add(add, fill_value=0).astype("int64")
                if len(counts) > 4 * counters:      # between reductions a few times more are held
                    counts, more = _reduce(counts, counters)
                    off += more
                held[c] = (counts, off)
        for c, (counts, off) in held.items():
            counts, more = _reduce(counts, counters)
            yield pa.RecordBatch.from_pydict({
                "column": [c] * (len(counts) + 1), "value": [*counts.index, None],
                "n": [*counts.tolist(), 0], "off": [0] * len(counts) + [off + more]}, schema=pa.schema(
                    [("column", pa.string()), ("value", pa.string()), ("n", pa.int64()), ("off", pa.int64())]))

    return run


def summary(rows: DataFrame, columns: Sequence[str], counters: int = COUNTERS) -> DataFrame:
    """Pass 1: (column, value, n, off) of every task.  ``n`` understates the value's rows in the task
    by ``off`` at most, which stands in one row (null value) per task and column."""
    texts = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return texts.mapInArrow(_summaries(columns, counters), "column string, value string, n long, off long")


def candidates(summaries: DataFrame, columns: Sequence[str], counters: int = COUNTERS) -> DataFrame:
    """(column, value, bound): the values with the largest merged counters, and the number of rows
    that no other value of the column exceeds.  A column is one partial top-k per task and
    a final one over what is left of it."""
    merged = write_shared(summaries.filter("value is not null").groupBy("column", "value").agg(F.sum("n").alias("n")))
    off = summaries.groupBy("column").agg(F.sum("off").alias("off"))
    parts = []
    for c in columns:
        top = merged.filter(F.col("column") == c).orderBy(F.desc("n"), "value").limit(counters + 1)
        parts.append(top)
    top = parts[0]
    for p in parts[1:]:
        top = top.unionByName(p)
    placed = top.groupBy("column").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "value"))).alias("all"))
    return placed.join(off, "column").select(
        "column", (F.coalesce(-F.get(F.col("all.less"), F.lit(counters)), F.lit(0)) + F.col("off")).alias("bound"),
        F.explode(F.slice("all.value", 1, counters)).alias("value"))


def heavy_hitters(rows: DataFrame, columns: Sequence[str], k: int = 5, counters: int = COUNTERS) -> DataFrame:
    """(column, value, count, rank): the ``k`` most frequent values of every column, exactly."""
    if k > counters:
        raise ValueError("k is more than the counters that a summary keeps")
    summaries = write_shared(summary(rows, columns, counters))
    chosen = write_shared(candidates(summaries, columns, counters))
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                                           for c in columns])).alias("x")).select("x.*")
    counted = (long.join(F.broadcast(chosen.select("column", "value")), ["column", "value"])
               .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))
    ranked = write_shared(top_k(counted, k).join(F.broadcast(chosen.select("column", "bound").distinct()), "column"))
    # a column is settled if its k-th candidate clears the bound, or if nothing was left out
    settled = {r["column"] for r in ranked.groupBy("column", "bound").agg(
        F.count(F.lit(1)).alias("n"), F.min("count").alias("least")).filter(
        (F.col("bound") == 0) | ((F.col("n") == k) & (F.col("least") > F.col("bound")))).collect()}
    known = {r["column"] for r in chosen.select("column").distinct().collect()}
    out = ranked.filter(F.col("column").isin(*settled)) if settled else ranked.limit(0)
    out = out.select("column", "value", "count", "rank")
    rest = [c for c in columns if c in known and c not in settled]
    return out.unionByName(_counted_in_full(long.filter(F.col("column").isin(*rest)), k)) if rest else out


def _counted_in_full(long: DataFrame, k: int, buckets: int = 64) -> DataFrame:
    """Every value of (column, value) counted; top k of each bucket of values, then of what is left."""
    counts = long.filter("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    bucketed = Window.partitionBy("column", "bucket").orderBy(F.desc("count"), "value")
    near = (counts.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
            .withColumn("r", F.row_number().over(bucketed)).filter(F.col("r") <= k))
    return top_k(near.select("column", "value", "count"), k)


def top_k(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest (column, value, count) per column with their rank; ``counts`` is small."""
    order = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

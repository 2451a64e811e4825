"""Approximate distinct counts and quantiles that roll up: sketches stored per day.

A day's sketch is a few KB whatever the number of rows, is made in one pass with a map-side
part, and can be merged with any others, so the distinct users or the median of any range of
days come from the stored table alone, without the log (distinct counts and medians of days do
not add up).  Distinct counts are HyperLogLog sketches with 2^``LG_K`` registers, quantiles
are KLL sketches.

Errors: an estimate of a distinct count lies within ``distinct_bound`` of the exact number with
probability over 99 %; the value returned for a quantile q is the exact quantile of some rank
within ``RANK_BOUND`` of q, with the same probability.  The exact operators (``profile``) stay
for when that is not enough.

Defined cases: null keys make no sketch of their own (rows with a null day are left out), null
values count in neither sketch; a range without days has an estimate of 0 and null quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: log2 of the registers of a distinct sketch: standard error 0.8 / sqrt(2^12), about 1.3 %
LG_K = 12
#: size parameter of a quantile sketch and the rank error it stands for
KLL_K, RANK_BOUND = 400, 0.01
#: three standard errors of a distinct sketch, as a share of the exact number
DISTINCT_BOUND = 3 * 0.83 / 2 ** (LG_K / 2)


def daily_sketches(rows: DataFrame, day: str, distinct: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per day: ``day``, ``n_rows``, for each of ``distinct`` a sketch ``<column>_hll``, for each
    of ``values`` a sketch ``<column>_kll``.  Write it as a table and merge from there."""
    col = lambda c: F.col(f"`{c}`")
    return rows.filter(col(day).isNotNull()).groupBy(col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.hll_sketch_agg(col(c), F.lit(LG_K)).alias(f"{c}_hll") for c in distinct],
        *[F.kll_sketch_agg_double(col(c).cast("double"), F.lit(KLL_K)).alias(f"{c}_kll") for c in values])


def _days_of(sketches: DataFrame, ranges: DataFrame) -> DataFrame:
    """Sketches with the number of every range (first, last) that has their day.  There are few
    days and few ranges: both are of calendar size."""
    return ranges.join(F.broadcast(sketches), F.col("day").between(F.col("first"), F.col("last")), "left")


def roll_up(sketches: DataFrame, ranges: DataFrame, distinct: Sequence[str], values: Sequence[str],
            quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per range (``first``, ``last``, both days included): ``n_rows``, ``<column>_distinct`` and
    ``<column>_quantiles`` (array), from stored sketches."""
    merged = _days_of(sketches, ranges).groupBy("first", "last").agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows"),
        *[F.hll_union_agg(f"{c}_hll").alias(f"{c}_hll") for c in distinct],
        *[F.kll_merge_agg_double(f"{c}_kll", F.lit(KLL_K)).alias(f"{c}_kll") for c in values])
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    return merged.select("first", "last", "n_rows",
                         *[F.coalesce(F.hll_sketch_estimate(f"{c}_hll"), F.lit(0)).cast("long").alias(f"{c}_distinct") for c in distinct],
                         *[F.when(F.kll_sketch_get_n_double(f"{c}_kll") > 0, F.kll_sketch_get_quantile_double(f"{c}_kll", asked))
                           .alias(f"{c}_quantiles") for c in values])


def distinct_ok(estimate: Column, exact: Column) -> Column:
    """Whether an estimate keeps its bound (one is always allowed, for small counts)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), F.lit(DISTINCT_BOUND) * exact)

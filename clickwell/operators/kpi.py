"""KPI and segment marts.

All marts are hash aggregations on their grain (partial aggregation map-side, then
one shuffle of at most one row per group per task), so a hot day, hour or segment
is pre-aggregated before it is shuffled.  Portfolio totals are taken from the
written mart, never from a second scan of the event log, and joined back as a one-row
broadcast (a proven size bound: exactly one row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_MIN_IMPRESSIONS, RANKING_LIMIT, SEGMENT_DIMS
from ..functions.core import safe_ratio
from ..session import write_shared


def _kpi_aggs(click_col: str = "click"):
    return [F.count(F.lit(1)).alias("impressions"),
            F.sum(click_col).cast("bigint").alias("clicks")]


def _with_ctr(df: DataFrame) -> DataFrame:
    return df.withColumn("ctr", safe_ratio("clicks", "impressions"))


def daily_kpis(stg: DataFrame, date_col: str = "event_date") -> DataFrame:
    """A2: impressions, clicks, CTR per day; rows without a date are dropped."""
    return _with_ctr(stg.filter(F.col(date_col).isNotNull())
                     .groupBy(date_col).agg(*_kpi_aggs()))


def hourly_trends(stg: DataFrame, date_col: str = "event_date",
                  hour_col: str = "event_hour", by: tuple[str, ...] = ()) -> DataFrame:
    """A3 / F1: per (date, hour); rows missing either are dropped.  ``by`` adds series
    keys (e.g. ``("device_type",)``) for forecasting many series in parallel."""
    return _with_ctr(stg.filter(F.col(date_col).isNotNull() & F.col(hour_col).isNotNull())
                     .groupBy(*by, date_col, hour_col).agg(*_kpi_aggs()))


def _with_share(seg: DataFrame, total: DataFrame) -> DataFrame:
    """Click share of a segment mart; ``total`` is one row with ``_total_clicks``."""
    return (seg.crossJoin(F.broadcast(total))
            .withColumn("click_share", safe_ratio("clicks", "_total_clicks")).drop("_total_clicks"))


def _click_total(mart: DataFrame) -> DataFrame:
    return mart.agg(F.coalesce(F.sum("clicks"), F.lit(0)).cast("bigint").alias("_total_clicks"))


def segment_performance(stg: DataFrame, dims: tuple[str, ...] = SEGMENT_DIMS) -> DataFrame:
    """A4 + A5: per segment (null dimension values kept as their own group), with the
    segment's share of all clicks (0.0 when there are no clicks).

    The mart is written once to the shared checkpoint folder and the total of its clicks
    is joined back as one broadcast row.  ``dims`` may be of any cardinality: no task holds
    more than its share of the mart, and the event log is read once."""
    seg = write_shared(_with_ctr(stg.groupBy(*dims).agg(*_kpi_aggs())))
    return _with_share(seg, _click_total(seg))


def portfolio(mart: DataFrame) -> DataFrame:
    """Roll-up of a KPI mart; CTR is re-derived from the sums, never averaged."""
    return _with_ctr(mart.agg(F.coalesce(F.sum("impressions"), F.lit(0)).cast("bigint")
                              .alias("impressions"),
                              F.coalesce(F.sum("clicks"), F.lit(0)).cast("bigint")
                              .alias("clicks")))


def _ranked(seg: DataFrame, min_impressions: int, limit: int, ascending: bool,
            dims: tuple[str, ...]) -> DataFrame:
    ctr = F.col("ctr").asc() if ascending else F.col("ctr").desc()
    keys = [ctr, F.col("impressions").desc()] + [F.col(d).asc_nulls_first() for d in dims]
    top = seg.filter(F.col("impressions") >= min_impressions).orderBy(*keys).limit(limit)
    # ``orderBy + limit`` plans TakeOrderedAndProject (per-task top-k, then merge);
    # the window below only numbers the <= ``limit`` survivors.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*keys)).cast("int"))


def top_segments(seg: DataFrame, min_impressions: int = DEFAULT_MIN_IMPRESSIONS,
                 limit: int = RANKING_LIMIT, dims: tuple[str, ...] = SEGMENT_DIMS) -> DataFrame:
    """Highest CTR among segments with enough impressions (ties: more impressions,
    then the dimension values)."""
    return _ranked(seg, min_impressions, limit, False, dims)


def bottom_segments(seg: DataFrame, min_impressions: int = DEFAULT_MIN_IMPRESSIONS,
                    limit: int = RANKING_LIMIT, dims: tuple[str, ...] = SEGMENT_DIMS) -> DataFrame:
    """Lowest CTR, ties by more impressions, then the dimension values."""
    return _ranked(seg, min_impressions, limit, True, dims)


def kpi_summary(stg: DataFrame, date_col: str = "event_date") -> DataFrame:
    """One-row summary of the daily mart with a reconciliation flag.

    Staging rows and the daily mart come from one aggregation: group by date keeping
    the null-date group, so the staging row count is the sum over all groups.
    """
    by_day = stg.groupBy(date_col).agg(*_kpi_aggs())
    dated = F.col(date_col).isNotNull()
    s = by_day.agg(
        F.sum(F.when(dated, 1).otherwise(0)).cast("bigint").alias("mart_row_count"),
        F.coalesce(F.sum(F.when(dated, F.col("impressions"))), F.lit(0)).cast("bigint")
        .alias("total_impressions"),
        F.coalesce(F.sum(F.when(dated, F.col("clicks"))), F.lit(0)).cast("bigint")
        .alias("total_clicks"),
        F.min(date_col).alias("min_event_date"),
        F.max(date_col).alias("max_event_date"),
        F.coalesce(F.sum("impressions"), F.lit(0)).cast("bigint").alias("staging_row_count"),
    )
    return s.withColumns({
        "overall_ctr": F.round(safe_ratio("total_clicks", "total_impressions"), 6),
        "success": (F.col("mart_row_count") > 0)
                   & (F.col("total_impressions") == F.col("staging_row_count")),
    })


def daily_listing(daily: DataFrame) -> DataFrame:
    """The daily marts as the run summary lists them (CTR to 6 dp)."""
    return daily.select("event_date", "impressions", "clicks", F.round("ctr", 6).alias("ctr"))


def segment_rankings(top: DataFrame, bottom: DataFrame, dims: tuple[str, ...] = SEGMENT_DIMS) -> DataFrame:
    """A10: both rankings of the funnel summary as rows (at most twice the limit)."""
    cols = ["rank", *dims, "impressions", "clicks", F.round("ctr", 6).alias("ctr"),
            F.round("click_share", 6).alias("click_share")]
    return top.select(F.lit("top_by_ctr").alias("ranking"), *cols).unionByName(
        bottom.select(F.lit("bottom_by_ctr").alias("ranking"), *cols))


def _funnel_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "overall_ctr": F.round(safe_ratio("total_clicks", "total_impressions"), 6),
        "success": ((F.col("hourly_rows") > 0) & (F.col("segment_rows") > 0)
                    & (F.col("total_impressions") == F.col("staging_row_count"))),
    })


def empty_tables(tables: dict[str, DataFrame]) -> list[str]:
    """Names of the tables without rows (a 1-row probe job each)."""
    return [name for name, df in tables.items() if df.isEmpty()]


def ensure_not_empty(tables: dict[str, DataFrame]) -> None:
    """A11 / R2 guard: raise when required tables have no rows, naming all of them."""
    empty = empty_tables(tables)
    if empty:
        raise RuntimeError(f"Empty tables: {', '.join(empty)}; build them before running this step.")


# ------------------------------------------------------------------ one-pass ad marts

HOURLY_SET, SEGMENT_SET = "hourly", "segment"


def ad_rollup(stg: DataFrame, dims: tuple[str, ...] = SEGMENT_DIMS,
              date_col: str = "event_date", hour_col: str = "event_hour") -> DataFrame:
    """All ad KPI marts from ONE scan of the staging table: a ``GROUPING SETS``
    aggregation over ``(date, hour)`` and over the segment dimensions.  Each input row
    is expanded once per set before the map-side partial aggregation, so the scan
    (the dominant cost at scale) happens once instead of once per mart.  The output
    is small (one row per hour plus one per segment) and is meant to be materialised
    once (``checkpoint`` or a written table) and then split with ``hourly_from`` /
    ``daily_from`` / ``segments_from``.  ``grouping_id`` separates a rolled-up column
    from a genuine null dimension value."""
    keys = [date_col, hour_col, *dims]
    g = stg.groupingSets([[date_col, hour_col], list(dims)], *keys).agg(
        F.grouping_id().alias("_gid"), *_kpi_aggs())
    # grouping_id bit i is set when keys[i] is rolled up (first key = highest bit).
    n = len(keys)
    hourly_gid = sum(1 << (n - 1 - i) for i, k in enumerate(keys) if k not in (date_col, hour_col))
    return g.withColumn("_set", F.when(F.col("_gid") == hourly_gid, F.lit(HOURLY_SET))
                        .otherwise(F.lit(SEGMENT_SET))).drop("_gid")


def hourly_from(rollup: DataFrame, date_col: str = "event_date",
                hour_col: str = "event_hour") -> DataFrame:
    """A3 from the rollup: (date, hour) groups without nulls."""
    return _with_ctr(rollup.filter((F.col("_set") == HOURLY_SET) & F.col(date_col).isNotNull()
                                   & F.col(hour_col).isNotNull())
                     .select(date_col, hour_col, "impressions", "clicks"))


def daily_from(rollup: DataFrame, date_col: str = "event_date") -> DataFrame:
    """A2 from the rollup: the (date, hour) groups summed per date.  Groups with a
    null hour are included, so this equals grouping the events by date."""
    return _with_ctr(rollup.filter((F.col("_set") == HOURLY_SET) & F.col(date_col).isNotNull())
                     .groupBy(date_col).agg(F.sum("impressions").cast("bigint").alias("impressions"),
                                            F.sum("clicks").cast("bigint").alias("clicks")))


def segments_from(rollup: DataFrame, dims: tuple[str, ...] = SEGMENT_DIMS) -> DataFrame:
    """A4 + A5 from a written rollup: every row is in one (date, hour) group, so the click
    total is that of the hourly rows, joined as one broadcast row."""
    seg = _with_ctr(rollup.filter(F.col("_set") == SEGMENT_SET).select(*dims, "impressions", "clicks"))
    return _with_share(seg, _click_total(rollup.filter(F.col("_set") == HOURLY_SET)))


def staging_rows_from(rollup: DataFrame) -> DataFrame:
    """Staging row count (one row, ``staging_row_count``): every row is in exactly one
    (date, hour) group."""
    return rollup.filter(F.col("_set") == HOURLY_SET).agg(
        F.coalesce(F.sum("impressions"), F.lit(0)).cast("bigint").alias("staging_row_count"))


def funnel_summary(rollup: DataFrame, date_col: str = "event_date",
                   hour_col: str = "event_hour") -> DataFrame:
    """A10 in one aggregation over the rollup (one consumer, so one scan of staging):
    hourly totals, CTR range, mart row counts and the reconciliation flag."""
    hourly_set = F.col("_set") == HOURLY_SET
    hourly_row = hourly_set & F.col(date_col).isNotNull() & F.col(hour_col).isNotNull()
    seg_row = F.col("_set") == SEGMENT_SET
    ctr = safe_ratio("clicks", "impressions")

    def total(cond, c):
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("bigint")

    s = rollup.agg(
        F.sum(F.when(hourly_row, 1).otherwise(0)).cast("bigint").alias("hourly_rows"),
        total(hourly_row, "impressions").alias("total_impressions"),
        total(hourly_row, "clicks").alias("total_clicks"),
        F.round(F.min(F.when(hourly_row, ctr)), 6).alias("min_hourly_ctr"),
        F.round(F.max(F.when(hourly_row, ctr)), 6).alias("max_hourly_ctr"),
        F.sum(F.when(seg_row, 1).otherwise(0)).cast("bigint").alias("segment_rows"),
        total(seg_row, "impressions").alias("segment_impressions"),
        total(hourly_set, "impressions").alias("staging_row_count"),
    )
    return _funnel_flags(s)

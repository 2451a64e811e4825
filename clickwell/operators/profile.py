"""Raw-data profiling.

Each profile is one or two aggregations over the raw frame: the per-column counters
(missing values, distinct counts, value frequencies) are computed by unpivoting the
profiled columns into ``(column_name, value)`` rows and aggregating once, so adding
columns adds rows, not jobs.  Top-k per column is two-stage (top-k inside salted
buckets, then top-k of the survivors) so no column's value set lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import decode_hour_code, is_binary, lenient_double, na_to_null, safe_ratio
from ..session import write_shared
from .clean import na_normalize, normalize_columns

AD_DISTINCT_COLUMNS = ("device_id", "device_type", "app_id", "app_category", "site_id",
                       "site_category", "banner_pos")
AD_TOP_COLUMNS = ("device_type", "app_category", "site_category")
TOP_K = 5


def _as_pandas_read(raw: DataFrame) -> DataFrame:
    """Raw text frame as a pandas CSV read would present it: lower-case names and
    missing-value tokens as null."""
    return na_normalize(normalize_columns(raw))


def _long(df: DataFrame, columns, null_text: str | None = None) -> DataFrame:
    """Unpivot ``columns`` into (column_name, value) text rows."""
    def val(c):
        v = F.col(c).cast("string")
        return F.coalesce(v, F.lit(null_text)) if null_text is not None else v
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), val(c).alias("value"))
                    for c in columns])
    return df.select(F.explode(arr).alias("kv")).select("kv.column_name", "kv.value")


def missing_summary(df: DataFrame) -> DataFrame:
    """Null count and percent (2 dp) per column, only columns with nulls."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.sum(F.col(c).isNull().cast("int")).cast("bigint").alias(c) for c in cols])
    long = wide.unpivot(["__rows"], cols, "column_name", "missing_count")
    return (long.filter(F.col("missing_count") > 0)
            .select("column_name", "missing_count",
                    F.round(F.col("missing_count") / F.col("__rows") * 100, 2).alias("missing_pct")))


BINS = 4096


def _values(df: DataFrame, column: str) -> DataFrame:
    x = F.col(column).cast("double")
    return df.select(x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))


def _value_at(values: DataFrame, rank: int, low: float, high: float) -> float:
    """The value of 0-based ``rank`` in sorted order, ``low`` and ``high`` being the least
    and the greatest.  Each pass counts the values per bin of the range that holds the rank
    (at most ``BINS`` rows, added up map-side) and goes on with one bin, from its least to
    its greatest value, so that a pass cuts the range at least ``BINS``-fold or ends."""
    below = 0
    while low < high:
        width = high / BINS - low / BINS
        x = F.col("_x")
        inside = values.filter((x >= F.lit(low)) & (x <= F.lit(high)))
        number = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)) if width > 0 else (x > F.lit(low)).cast("int")
        bins = inside.groupBy(number.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"),
                                                     F.max("_x").alias("hi")).collect()
        for r in sorted(bins, key=lambda r: r.b):
            if below + r.n > rank:
                break
            below += r.n
        else:
            raise AssertionError(f"rank {rank} is not among the {below} values counted")
        if (r.lo, r.hi) == (low, high):  # a bin that cannot be cut further
            raise AssertionError(f"no progress between {low!r} and {high!r}")
        low, high = r.lo, r.hi
    return low


def exact_median(df: DataFrame, column: str) -> float | None:
    """Exact median (mean of the two middle values for an even count; None for no values).
    Neither the column nor its distinct values are gathered: what a task holds and sends
    is at most ``BINS`` counters, whatever the column."""
    values = write_shared(_values(df, column))
    x = F.col("_x")
    s = values.agg(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    return _median(values, s.n, s.lo, s.hi)


def _median(values: DataFrame, n: int, low: float, high: float) -> float | None:
    if not n:
        return None
    first = _value_at(values, (n - 1) // 2, low, high)
    second = first
    if n % 2 == 0:  # the same value again, or the next greater one
        x = F.col("_x")
        s = values.agg(F.sum(F.when(x <= F.lit(first), 1).otherwise(0)).alias("upto"),
                       F.min(F.when(x > F.lit(first), x)).alias("next")).first()
        second = first if s.upto > n // 2 else s.next
    return first + (second - first) * 0.5


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Min, max, mean (4 dp), exact median, sample std (4 dp; 0.0 for one value) of the
    non-null values.  The column is written once to the shared folder (its input may be
    costly); one aggregation gives the statistics, and the median takes a few counting
    passes (see ``exact_median``)."""
    values = write_shared(_values(df, column))
    x = F.col("_x")
    s = values.agg(F.count(x).alias("n"), F.min(x).alias("min"), F.max(x).alias("max"),
                   F.round(F.avg(x), 4).alias("mean"), F.round(F.stddev_samp(x), 4).alias("std")).first()
    row = (column, s.n, s.min, s.max, s["mean"], _median(values, s.n, s.min, s.max), 0.0 if s.n == 1 else s["std"])
    return df.sparkSession.createDataFrame(
        [row], "column_name string, n bigint, min double, max double, mean double, median double, std double")


def distinct_counts(df: DataFrame, columns, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (exact by default; HyperLogLog++ with
    ``approx`` for very wide logs, which avoids shuffling the value sets)."""
    long = _long(df, columns).filter(F.col("value").isNotNull())
    if approx:
        return long.groupBy("column_name").agg(
            F.approx_count_distinct("value").cast("bigint").alias("distinct_count"))
    return (long.distinct()
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count")))


def value_counts(df: DataFrame, columns, null_text: str = "nan") -> DataFrame:
    """Frequency of every value (null shown as text), per column."""
    return (_long(df, columns, null_text).groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("count")))


def top_values(df: DataFrame, columns, k: int = TOP_K, buckets: int = 64,
               null_text: str = "nan") -> DataFrame:
    """The k most frequent values per column (ties by value), with ``rank``."""
    counts = value_counts(df, columns, null_text)
    order = [F.col("count").desc(), F.col("value").asc()]
    stage1 = (counts.withColumn("_b", F.pmod(F.xxhash64("value"), F.lit(buckets)))
              .withColumn("_r", F.row_number().over(
                  Window.partitionBy("column_name", "_b").orderBy(*order)))
              .filter(F.col("_r") <= k))
    return (stage1.withColumn("rank", F.row_number().over(
                Window.partitionBy("column_name").orderBy(*order)).cast("int"))
            .filter(F.col("rank") <= k).select("column_name", "value", "count", "rank"))


# ------------------------------------------------------------------ ads profile

def ads_valid_clicks(raw: DataFrame) -> DataFrame:
    """P3 restriction: rows whose click parses as 0 or 1."""
    df = _as_pandas_read(raw)
    return df.filter(is_binary(lenient_double("click")))


def ads_click_stats(raw: DataFrame) -> DataFrame:
    """P3-P5 + P8 header: rows, columns, click split, CTR (6 dp) and percent (4 dp),
    date range from the hour code.  ``invalid`` counts rows the click rule rejects
    (over the raw input, since the profile itself keeps only valid rows)."""
    df = _as_pandas_read(raw)
    click = lenient_double("click")
    valid = is_binary(click)
    date = F.to_date(decode_hour_code("hour"))

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    s = df.agg(
        n(valid).alias("row_count"),
        n(valid & (click == 0)).alias("no_click"),
        n(valid & (click == 1)).alias("click"),
        n(~valid).alias("invalid"),
        F.min(F.when(valid, date)).alias("min_event_date"),
        F.max(F.when(valid, date)).alias("max_event_date"),
        F.countDistinct(F.when(valid, date)).cast("bigint").alias("distinct_days"),
    )
    ctr = safe_ratio("click", "row_count")
    return s.select(F.lit("avazu_mobile_ads").alias("dataset"), "row_count",
                    F.lit(len(df.columns)).alias("column_count"), "no_click", "click", "invalid",
                    F.round(ctr, 6).alias("ctr"), F.round(ctr * 100, 4).alias("ctr_pct"),
                    "min_event_date", "max_event_date", "distinct_days")


# ------------------------------------------------------------ experiment profile

def experiment_columns(columns: list[str]) -> dict[str, str]:
    """P14 column fallback: arm, outcome, purchase and money columns."""
    cols = [c.strip().lower() for c in columns]
    arm = "segment" if "segment" in cols else ("treatment" if "treatment" in cols else cols[-2])
    outcome = "visit" if "visit" in cols else "conversion"
    purchase = "conversion" if "conversion" in cols else outcome
    money = "spend" if "spend" in cols else "revenue"
    return {"arm": arm, "outcome": outcome, "purchase": purchase, "money": money}


def _zero_filled(c: str):
    return F.coalesce(lenient_double(c), F.lit(0.0))


def experiment_overview(raw: DataFrame) -> DataFrame:
    """P9 + P11: recipients, visit / conversion rates (6 dp) and percents (4 dp),
    binary splits.  Unparseable outcome values count as 0."""
    df = _as_pandas_read(raw)
    k = experiment_columns(df.columns)
    v, c = _zero_filled(k["outcome"]), _zero_filled(k["purchase"])

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    s = df.agg(F.count(F.lit(1)).alias("row_count"),
               F.sum(v).cast("bigint").alias("visits"), F.sum(c).cast("bigint").alias("conversions"),
               n(v == 0).alias("no_visit"), n(v == 1).alias("visit"),
               n(c == 0).alias("no_conversion"), n(c == 1).alias("conversion"))
    vr, cr = safe_ratio("visits", "row_count"), safe_ratio("conversions", "row_count")
    return s.select("row_count", F.lit(len(df.columns)).alias("column_count"), "visits",
                    "conversions", F.round(vr, 6).alias("visit_rate"),
                    F.round(vr * 100, 4).alias("visit_rate_pct"),
                    F.round(cr, 6).alias("conversion_rate"),
                    F.round(cr * 100, 4).alias("conversion_rate_pct"),
                    "no_visit", "visit", "no_conversion", "conversion")


def arm_profile(raw: DataFrame) -> DataFrame:
    """Per-arm recipients, visits, conversions, rates (6 dp), revenue (2 dp) and
    revenue per recipient (4 dp); rows without an arm are excluded."""
    df = _as_pandas_read(raw)
    k = experiment_columns(df.columns)
    g = (df.filter(F.col(k["arm"]).isNotNull())
         .groupBy(F.col(k["arm"]).cast("string").alias("segment"))
         .agg(F.count(F.lit(1)).alias("recipients"),
              F.sum(_zero_filled(k["outcome"])).alias("_v"),
              F.sum(_zero_filled(k["purchase"])).alias("_c"),
              F.sum(_zero_filled(k["money"])).alias("_r")))
    return g.select("segment", "recipients", F.col("_v").cast("bigint").alias("visits"),
                    F.round(safe_ratio("_v", "recipients"), 6).alias("visit_rate"),
                    F.col("_c").cast("bigint").alias("conversions"),
                    F.round(safe_ratio("_c", "recipients"), 6).alias("conversion_rate"),
                    F.round("_r", 2).alias("total_revenue"),
                    F.round(safe_ratio("_r", "recipients"), 4).alias("revenue_per_customer"))


def revenue_distribution(raw: DataFrame) -> DataFrame:
    """P2 on the money column with unparseable / missing values as 0."""
    df = _as_pandas_read(raw)
    k = experiment_columns(df.columns)
    return distribution(df.select(_zero_filled(k["money"]).alias(k["money"])), k["money"])


__all__ = ["missing_summary", "distribution", "distinct_counts", "value_counts", "top_values",
           "ads_valid_clicks", "ads_click_stats", "experiment_overview", "arm_profile",
           "revenue_distribution", "na_to_null"]


def profile_ads(raw: DataFrame, distinct_columns=AD_DISTINCT_COLUMNS, top_columns=AD_TOP_COLUMNS,
                k: int = TOP_K, approx_distinct: bool = False) -> dict[str, DataFrame]:
    """The ad-log profile as named DataFrames (all lazy).  A missing ``click``
    column fails immediately."""
    if "click" not in [c.strip().lower() for c in raw.columns]:
        raise ValueError("ad log has no click column")
    valid = ads_valid_clicks(raw)
    return {"summary": ads_click_stats(raw), "missing_values": missing_summary(valid),
            "unique_counts": distinct_counts(valid, distinct_columns, approx_distinct),
            "top_values": top_values(valid, top_columns, k)}


def profile_experiment(raw: DataFrame) -> dict[str, DataFrame]:
    """The experiment profile as named DataFrames (the distribution is computed
    at once, the others are lazy)."""
    df = _as_pandas_read(raw)
    k = experiment_columns(df.columns)
    dist_cols = [c for c in ("zip_code", "channel") if c in df.columns]
    return {"summary": experiment_overview(raw), "missing_values": missing_summary(df),
            "treatment_counts": value_counts(df, [k["arm"]]),
            "segment_metrics": arm_profile(raw),
            "revenue_distribution": revenue_distribution(raw),
            "value_counts": value_counts(df, dist_cols) if dist_cols else None}

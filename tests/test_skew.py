"""A third of all rows on one key must give the same answers (partial aggregation and
windows over aggregated rows only; nothing is sampled or capped)."""
import datetime as dt

from pyspark.sql import functions as F

from clickwell.operators import experiment as X, kpi, profile as P


def test_hot_segment_and_hour(spark):
    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 7).cast("int")).alias("device_type"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("a"), (F.col("id") % 11).cast("string"))).alias("app_category"),
        F.lit("s").alias("site_category"), F.lit(0).alias("banner_pos"),
        (F.col("id") % 5 == 0).cast("int").alias("click"),
        F.lit(dt.date(2024, 1, 1)).alias("event_date"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise((F.col("id") % 24).cast("int")).alias("event_hour"))
    seg = {(r.device_type, r.app_category): r for r in kpi.segment_performance(base).collect()}
    hot = seg[(1, "hot")]
    assert hot.impressions == n // 3
    assert abs(sum(r.click_share for r in seg.values()) - 1.0) < 1e-12
    roll = kpi.ad_rollup(base)
    assert kpi.staging_rows_from(roll).first()[0] == n
    assert kpi.daily_from(roll).first().impressions == n
    hourly = {r.event_hour: r.impressions for r in kpi.hourly_from(roll).collect()}
    assert sum(hourly.values()) == n and hourly[5] > n // 3


def test_hot_arm(spark):
    n = 30000
    stg = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.lit("control")).otherwise(F.lit("mens_email")).alias("treatment_group"),
        F.lit("x").alias("treatment_label"),
        (F.col("id") % 4 == 0).cast("int").alias("converted"),
        F.lit(1.25).alias("revenue"))
    rows = {r.treatment_group: r for r in X.ab_results(stg).collect()}
    assert rows["control"].recipients == 20000 and rows["mens_email"].recipients == 10000
    assert rows["control"].total_revenue == 25000.0


def test_hot_value_top_k_and_median(spark):
    vals = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.col("id").cast("double")).alias("x"))
    top = P.top_values(vals, ["v"], k=2, buckets=16).orderBy("rank").collect()
    assert top[0]["value"] == "hot" and top[0]["count"] == 6667
    import statistics
    xs = [0.0 if i % 3 == 0 else float(i) for i in range(20000)]
    assert P.exact_median(vals, "x") == statistics.median(xs)

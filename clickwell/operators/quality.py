"""Validation checks, metric locks and drift comparison.

Every table contributes one small aggregation (row count plus the sums the checks
need); the one-row results are cross-joined (broadcast, one row each) into a single
metrics row and expanded into one row per check.  The raw inputs' row counts are taken
as given one-row frames, so that a pipeline can count them while it stages them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CONTROL_GROUP, VALIDATION_TOLERANCE
from ..functions.core import safe_ratio

# --- fixed values that must equal the reference ----------------------------------
CHECK_NAMES = (
    "raw_avazu_ads_row_count", "raw_hillstrom_email_row_count", "stg_ad_events_row_count",
    "stg_email_experiment_row_count", "stg_ad_events_ctr", "stg_email_experiment_visit_rate",
    "stg_email_experiment_treatment_groups", "mart_campaign_kpis_populated",
    "mart_campaign_kpis_ctr", "mart_ctr_trends_populated", "mart_ctr_trends_impressions",
    "mart_ctr_trends_ctr", "mart_device_app_performance_populated",
    "mart_device_app_performance_impressions", "mart_device_app_performance_click_share",
    "mart_ab_test_results_populated", "mart_ab_test_results_group_counts",
    "mart_ab_test_results_recipients", "mart_ab_test_results_overall_conversion_rate",
    "mart_ab_test_results_treatment_significance", "mart_forecast_inputs_populated",
    "mart_forecast_inputs_impressions", "mart_forecast_inputs_ctr",
    "mart_forecast_results_populated", "mart_forecast_results_metrics",
)
# ----------------------------------------------------------------------------------


def counts_text(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """One-row canonical text of a small key -> count map: 'k1=v1,k2=v2' (sorted)."""
    return df.agg(F.concat_ws(",", F.array_sort(F.collect_list(
        F.concat(F.coalesce(F.col(key).cast("string"), F.lit("None")), F.lit("="),
                 F.col(value).cast("string"))))).alias(alias))


def _stg_arms(stg_experiment: DataFrame) -> DataFrame:
    per_arm = stg_experiment.groupBy("treatment_group").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("visit").cast("double")).alias("v"))
    return per_arm.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("stg_exp_rows"),
        (F.sum("v") / F.sum("n")).alias("stg_exp_visit_rate"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.concat(
            F.coalesce(F.col("treatment_group").cast("string"), F.lit("None")), F.lit("="),
            F.col("n").cast("string"))))).alias("stg_groups"))


def _no_variance():
    """Neither the arm nor the control has both outcomes, so the pooled variance is 0."""
    rate, control = F.col("conversion_rate"), F.col("control_conversion_rate")
    return (rate == control) & rate.isin(0.0, 1.0)


def _f6(c):
    return F.format_string("%.6f", F.round(c, 6))


def count_rows(df: DataFrame) -> DataFrame:
    """One row ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def validation_checks(*, raw_ads_rows: DataFrame, raw_experiment_rows: DataFrame, stg_ads: DataFrame,
                      stg_experiment: DataFrame, daily: DataFrame, hourly: DataFrame,
                      segments: DataFrame, ab: DataFrame, forecast_inputs: DataFrame,
                      forecast_results: DataFrame, ads_summary: DataFrame,
                      experiment_summary: DataFrame, tol: float = VALIDATION_TOLERANCE,
                      pending_marts: dict[str, DataFrame] | None = None) -> DataFrame:
    """The 25 named checks as rows (check_order, check_name, status, expected,
    actual, message).  Expectations come from the cleaning summaries; ``raw_*_rows`` are
    one-row frames ``n``."""
    def kpis(df, p):
        return df.agg(F.count(F.lit(1)).alias(f"{p}_rows"),
                      F.coalesce(F.sum("impressions"), F.lit(0)).cast("bigint").alias(f"{p}_impr"),
                      F.coalesce(F.sum("clicks"), F.lit(0)).cast("bigint").alias(f"{p}_clicks"))

    parts = [
        raw_ads_rows.select(F.col("n").alias("raw_ads_rows")),
        raw_experiment_rows.select(F.col("n").alias("raw_exp_rows")),
        stg_ads.agg(F.count(F.lit(1)).alias("stg_ads_rows"),
                    F.avg(F.col("click").cast("double")).alias("stg_ads_ctr")),
        # rows, visit rate and per-arm counts from one pass over the staging table
        _stg_arms(stg_experiment),
        kpis(daily, "daily"), kpis(hourly, "hourly"), kpis(forecast_inputs, "finp"),
        segments.agg(F.count(F.lit(1)).alias("seg_rows"),
                     F.coalesce(F.sum("impressions"), F.lit(0)).cast("bigint").alias("seg_impr"),
                     F.coalesce(F.sum("click_share"), F.lit(0.0)).alias("seg_share")),
        ab.agg(F.count(F.lit(1)).alias("ab_rows"),
               F.coalesce(F.sum("recipients"), F.lit(0)).cast("bigint").alias("ab_recipients"),
               F.coalesce(F.sum("conversions"), F.lit(0)).cast("bigint").alias("ab_conversions"),
               # a test without variance has no p-value; it counts as tested
               F.sum(F.when((F.col("treatment_group") != CONTROL_GROUP)
                            & (F.col("p_value").isNotNull() | _no_variance()), 1).otherwise(0))
               .cast("bigint").alias("ab_p_rows")),
        counts_text(ab, "treatment_group", "recipients", "ab_groups"),
        forecast_results.agg(F.count(F.lit(1)).alias("fres_rows"),
                             F.sum(F.when(F.col("mae").isNotNull() & F.col("rmse").isNotNull()
                                          & F.col("model_name").isNotNull(), 1).otherwise(0))
                             .cast("bigint").alias("fres_metric_rows")),
        ads_summary.select(F.col("input_rows").alias("exp_ads_in"),
                           F.col("output_rows").alias("exp_ads_out"),
                           F.col("ctr").alias("exp_ads_ctr")),
        experiment_summary.select(
            F.col("input_rows").alias("exp_exp_in"), F.col("output_rows").alias("exp_exp_out"),
            F.col("visit_rate").alias("exp_visit_rate"),
            # expected arm counts: the cleaning summary's per-arm map as canonical text
            F.concat_ws(",", F.array_sort(F.transform(
                F.map_entries("treatment_group_counts"),
                lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))))
            .alias("exp_groups")),
    ]
    row = parts[0]
    for p in parts[1:]:
        row = row.crossJoin(F.broadcast(p))
    c = F.col
    n_groups = F.size(F.split(c("exp_groups"), ","))

    def approx(actual, expected, populated=F.lit(True)):
        return populated & (F.abs(F.coalesce(actual, F.lit(0.0)) - expected) <= tol)

    ratio = lambda n, d: safe_ratio(c(n), c(d))
    checks = [
        # (name, passed, expected text, actual text)
        (CHECK_NAMES[0], c("raw_ads_rows") == c("exp_ads_in"), c("exp_ads_in"), c("raw_ads_rows")),
        (CHECK_NAMES[1], c("raw_exp_rows") == c("exp_exp_in"), c("exp_exp_in"), c("raw_exp_rows")),
        (CHECK_NAMES[2], c("stg_ads_rows") == c("exp_ads_out"), c("exp_ads_out"), c("stg_ads_rows")),
        (CHECK_NAMES[3], c("stg_exp_rows") == c("exp_exp_out"), c("exp_exp_out"), c("stg_exp_rows")),
        (CHECK_NAMES[4], approx(c("stg_ads_ctr"), c("exp_ads_ctr")), _f6(c("exp_ads_ctr")),
         _f6(F.coalesce(c("stg_ads_ctr"), F.lit(0.0)))),
        (CHECK_NAMES[5], approx(c("stg_exp_visit_rate"), c("exp_visit_rate")),
         _f6(c("exp_visit_rate")), _f6(F.coalesce(c("stg_exp_visit_rate"), F.lit(0.0)))),
        (CHECK_NAMES[6], c("stg_groups") == c("exp_groups"), c("exp_groups"), c("stg_groups")),
        (CHECK_NAMES[7], c("daily_rows") > 0, F.lit("> 0"), c("daily_rows")),
        (CHECK_NAMES[8], approx(ratio("daily_clicks", "daily_impr"), c("exp_ads_ctr"),
                                c("daily_rows") > 0),
         _f6(c("exp_ads_ctr")), _f6(ratio("daily_clicks", "daily_impr"))),
        (CHECK_NAMES[9], c("hourly_rows") > 0, F.lit("> 0"), c("hourly_rows")),
        (CHECK_NAMES[10], (c("hourly_rows") > 0) & (c("hourly_impr") == c("exp_ads_out")),
         c("exp_ads_out"), c("hourly_impr")),
        (CHECK_NAMES[11], approx(ratio("hourly_clicks", "hourly_impr"), c("exp_ads_ctr"),
                                 c("hourly_rows") > 0),
         _f6(c("exp_ads_ctr")), _f6(ratio("hourly_clicks", "hourly_impr"))),
        (CHECK_NAMES[12], c("seg_rows") > 0, F.lit("> 0"), c("seg_rows")),
        (CHECK_NAMES[13], (c("seg_rows") > 0) & (c("seg_impr") == c("exp_ads_out")),
         c("exp_ads_out"), c("seg_impr")),
        (CHECK_NAMES[14], approx(c("seg_share"), F.lit(1.0), c("seg_rows") > 0),
         _f6(F.lit(1.0)), _f6(c("seg_share"))),
        (CHECK_NAMES[15], c("ab_rows") == n_groups, n_groups, c("ab_rows")),
        (CHECK_NAMES[16], (c("ab_rows") == n_groups) & (c("ab_groups") == c("exp_groups")),
         c("exp_groups"), c("ab_groups")),
        (CHECK_NAMES[17], (c("ab_rows") == n_groups) & (c("ab_recipients") == c("exp_exp_out")),
         c("exp_exp_out"), c("ab_recipients")),
        (CHECK_NAMES[18], approx(ratio("ab_conversions", "ab_recipients"), c("exp_visit_rate"),
                                 c("ab_rows") == n_groups),
         _f6(c("exp_visit_rate")), _f6(ratio("ab_conversions", "ab_recipients"))),
        (CHECK_NAMES[19], (c("ab_rows") == n_groups) & (c("ab_p_rows") == n_groups - 1),
         n_groups - 1, c("ab_p_rows")),
        (CHECK_NAMES[20], c("finp_rows") > 0, F.lit("> 0"), c("finp_rows")),
        (CHECK_NAMES[21], (c("finp_rows") > 0) & (c("finp_impr") == c("exp_ads_out")),
         c("exp_ads_out"), c("finp_impr")),
        (CHECK_NAMES[22], approx(ratio("finp_clicks", "finp_impr"), c("exp_ads_ctr"),
                                 c("finp_rows") > 0),
         _f6(c("exp_ads_ctr")), _f6(ratio("finp_clicks", "finp_impr"))),
        (CHECK_NAMES[23], c("fres_rows") > 0, F.lit("> 0"), c("fres_rows")),
        (CHECK_NAMES[24], (c("fres_rows") > 0) & (c("fres_metric_rows") == c("fres_rows")),
         c("fres_rows"), c("fres_metric_rows")),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("check_order"), F.lit(name).alias("check_name"),
                             F.when(F.coalesce(ok, F.lit(False)), F.lit("pass"))
                             .otherwise(F.lit("fail")).alias("status"),
                             exp.cast("string").alias("expected"),
                             act.cast("string").alias("actual"))
                    for i, (name, ok, exp, act) in enumerate(checks)])
    out = row.select(F.explode(arr).alias("c")).select("c.*")
    out = out.withColumn("message", F.concat(
        F.col("check_name"), F.lit(": "), F.col("status"), F.lit(" (expected "),
        F.coalesce(F.col("expected"), F.lit("None")), F.lit(", actual "),
        F.coalesce(F.col("actual"), F.lit("None")), F.lit(")")))
    for name, df in (pending_marts or {}).items():   # V9: marts not yet built stay empty
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(len(checks)).alias("check_order"), F.lit(f"{name}_empty").alias("check_name"),
            F.when(F.col("n") == 0, "pass").otherwise("fail").alias("status"),
            F.lit("0").alias("expected"), F.col("n").cast("string").alias("actual"),
            F.concat(F.lit(f"{name}_empty: "), F.when(F.col("n") == 0, "pass").otherwise("fail"),
                     F.lit(" (expected 0, actual "), F.col("n").cast("string"), F.lit(")"))
            .alias("message")))
    return out


def validation_summary(checks: DataFrame) -> DataFrame:
    """V10 roll-up: passed / failed counts and overall success."""
    s = checks.agg(F.sum(F.when(F.col("status") == "pass", 1).otherwise(0)).cast("bigint")
                   .alias("passed_count"),
                   F.sum(F.when(F.col("status") != "pass", 1).otherwise(0)).cast("bigint")
                   .alias("failed_count"),
                   F.count(F.lit(1)).alias("checks"))
    return s.withColumn("success", F.col("failed_count") == 0)


# --- fixed values that must equal the reference: steps that a lock needs ---------
REQUIRED_STEPS = ("campaign", "funnel", "ab_test", "forecast", "recommendations", "exports",
                  "validation")
# ----------------------------------------------------------------------------------


def lock_snapshot(metrics: DataFrame, steps: DataFrame,
                  required: tuple[str, ...] = REQUIRED_STEPS) -> DataFrame:
    """L1: freeze (metric, value, tolerance) rows.  ``steps`` holds (step, success) of the
    run; a required step that is missing or did not succeed fails the job, and the error
    names all of them."""
    done = F.collect_set(F.when(F.coalesce(F.col("success"), F.lit(False)), F.col("step")))
    bad = F.array_sort(F.array_except(F.array(*[F.lit(x) for x in required]), done))
    guard = steps.agg(bad.alias("_bad"))
    return metrics.crossJoin(F.broadcast(guard)).withColumn("value", F.when(
        F.size("_bad") > 0, F.raise_error(F.concat(
            F.lit("Cannot lock metrics, steps missing or failed: "), F.array_join("_bad", ", ")))
        .cast("double")).otherwise(F.col("value"))).drop("_bad")


def lock_drift(current: DataFrame, locked: DataFrame) -> DataFrame:
    """L2: compare current metrics with locked values (per-metric tolerance):
    status ok / drift / missing (locked but not produced) / new (not locked)."""
    cur = current.select("metric", F.col("value").alias("current_value"))
    lck = locked.select("metric", F.col("value").alias("locked_value"), "tolerance")
    j = lck.join(cur, "metric", "full_outer")
    status = (F.when(F.col("locked_value").isNull() & F.col("current_value").isNotNull()
                     & F.col("tolerance").isNull(), F.lit("new"))
              .when(F.col("current_value").isNull(), F.lit("missing"))
              .when(F.abs(F.col("current_value") - F.col("locked_value")) <= F.col("tolerance"),
                    F.lit("ok"))
              .otherwise(F.lit("drift")))
    return j.select("metric", "locked_value", "current_value", "tolerance",
                    (F.col("current_value") - F.col("locked_value")).alias("difference"),
                    status.alias("status"))


def metric_rows(one_row: DataFrame, metrics: list[tuple[str, str, float]]) -> DataFrame:
    """Unpivot a one-row frame into (metric, value, tolerance) rows."""
    arr = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(col).cast("double").alias("value"),
                             F.lit(float(tol)).alias("tolerance"))
                    for name, col, tol in metrics])
    return one_row.select(F.explode(arr).alias("m")).select("m.*")


def lock_metrics(*, ads_summary: DataFrame, experiment_summary: DataFrame, daily: DataFrame,
                 hourly: DataFrame, segments: DataFrame, top: DataFrame, ab: DataFrame,
                 forecast_inputs: DataFrame, forecast_metrics: DataFrame,
                 forecast_results: DataFrame, recommendations: DataFrame,
                 arms: tuple[str, ...], actions: tuple[str, ...]) -> DataFrame:
    """L1 metric set: cleaning counts and rates, portfolio, top segment, mart sizes,
    per-arm lift / incremental revenue, selected forecast errors, action counts."""
    def rows(df, alias):
        return df.agg(F.count(F.lit(1)).alias(alias))

    parts = [
        metric_rows(ads_summary, [("ads.input_rows", "input_rows", 0), ("ads.output_rows", "output_rows", 0),
                                  ("ads.ctr", "ctr", 1e-6)]),
        metric_rows(experiment_summary, [("experiment.input_rows", "input_rows", 0),
                                         ("experiment.output_rows", "output_rows", 0),
                                         ("experiment.visit_rate", "visit_rate", 1e-6),
                                         ("experiment.conversion_rate", "conversion_rate", 1e-6)]),
        metric_rows(daily.agg(F.sum("impressions").alias("i"), F.sum("clicks").alias("c"))
                    .withColumn("r", safe_ratio("c", "i")),
                    [("portfolio.impressions", "i", 0), ("portfolio.clicks", "c", 0),
                     ("portfolio.ctr", "r", 1e-6)]),
        metric_rows(top.filter(F.col("rank") == 1),
                    [("top_segment.ctr", "ctr", 1e-6), ("top_segment.impressions", "impressions", 0)]),
    ]
    for name, df in (("daily", daily), ("hourly", hourly), ("segments", segments), ("ab", ab),
                     ("forecast_inputs", forecast_inputs), ("forecast_results", forecast_results)):
        parts.append(metric_rows(rows(df, "n"), [(f"mart.{name}.rows", "n", 0)]))
    for arm in arms:
        parts.append(metric_rows(ab.filter(F.col("treatment_group") == arm),
                                 [(f"ab.{arm}.absolute_lift", "absolute_lift", 1e-6),
                                  (f"ab.{arm}.relative_lift_pct", "relative_lift_pct", 1e-4),
                                  (f"ab.{arm}.incremental_revenue", "incremental_revenue", 1.0)]))
    parts.append(metric_rows(forecast_metrics.filter("selected"),
                             [("forecast.mae", "mae", 1e-6), ("forecast.rmse", "rmse", 1e-6),
                              ("forecast.mape", "mape", 1e-6)]))
    counts = recommendations.groupBy().pivot("action", list(actions)).agg(F.count(F.lit(1)))
    parts.append(metric_rows(counts.select(*[F.coalesce(F.col(a), F.lit(0)).alias(a)
                                             for a in actions]),
                             [(f"recommendations.{a.lower()}", a, 0) for a in actions]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

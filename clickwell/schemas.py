"""Table contracts for the three layers (raw, staging, mart).

Raw tables are read as text (every column ``string``) and typed by the cleaning
operators; staging and mart schemas are applied with ``DataFrame.to(schema)``,
which reconciles by name, so column order is explicit rather than positional.
``created_at`` is stamped on marts at write time (see ``sources.sinks``).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
DT = T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# --- fixed values that must equal the reference: columns and types of every table ------
# Raw ad log columns in file order (header spelling differs only in case: C1, C14..C21).
ADS_RAW_COLUMNS = [
    "id", "click", "hour", "c1", "banner_pos", "site_id", "site_domain", "site_category",
    "app_id", "app_domain", "app_category", "device_id", "device_ip", "device_model",
    "device_type", "device_conn_type", "c14", "c15", "c16", "c17", "c18", "c19", "c20", "c21",
]
EXPERIMENT_RAW_COLUMNS = [
    "recency", "history_segment", "history", "mens", "womens", "zip_code", "newbie",
    "channel", "segment", "visit", "conversion", "spend",
]

# Raw files are read with an all-string schema: no inference, ids keep full precision.
ADS_RAW_TEXT = _struct(*[(c, S) for c in ADS_RAW_COLUMNS])
EXPERIMENT_RAW_TEXT = _struct(*[(c, S) for c in EXPERIMENT_RAW_COLUMNS])

# Strictly typed raw tables.
RAW_ADS = _struct(
    ("id", S), ("click", I), ("hour", L), ("c1", L), ("banner_pos", I), ("site_id", S),
    ("site_domain", S), ("site_category", S), ("app_id", S), ("app_domain", S),
    ("app_category", S), ("device_id", S), ("device_ip", S), ("device_model", S),
    ("device_type", I), ("device_conn_type", I), ("c14", D), ("c15", D), ("c16", D),
    ("c17", D), ("c18", D), ("c19", D), ("c20", D), ("c21", D),
)
RAW_EXPERIMENT = _struct(
    ("recency", I), ("history_segment", S), ("history", D), ("mens", I), ("womens", I),
    ("zip_code", S), ("newbie", I), ("channel", S), ("segment", S), ("visit", I),
    ("conversion", I), ("spend", D),
)

# Monitored columns, in output order.
FLAG_COLUMNS = [
    "site_id", "site_domain", "site_category", "app_id", "app_domain", "app_category",
    "device_id", "device_model", "device_type",
]

STG_ADS = T.StructType(
    RAW_ADS.fields
    + [T.StructField("event_date", DT, True), T.StructField("event_hour", I, True)]
    + [T.StructField(f"flag_unknown_{c}", B, True) for c in FLAG_COLUMNS]
    + [T.StructField("flag_missing_fields", B, True)]
)
STG_EXPERIMENT = T.StructType(
    RAW_EXPERIMENT.fields
    + _struct(("treatment_group", S), ("treatment_label", S), ("converted", I),
              ("revenue", D), ("zip_code_std", S), ("flag_zip_code_typo", B),
              ("flag_missing_fields", B)).fields
)

MART_CAMPAIGN_KPIS = _struct(("event_date", DT), ("impressions", L), ("clicks", L), ("ctr", D))
MART_CTR_TRENDS = _struct(("event_date", DT), ("event_hour", I), ("impressions", L),
                          ("clicks", L), ("ctr", D))
MART_FORECAST_INPUTS = MART_CTR_TRENDS
MART_SEGMENTS = _struct(("device_type", I), ("app_category", S), ("site_category", S),
                        ("banner_pos", I), ("impressions", L), ("clicks", L), ("ctr", D),
                        ("click_share", D))
MART_AB_RESULTS = _struct(
    ("treatment_group", S), ("treatment_label", S), ("recipients", L), ("conversions", L),
    ("conversion_rate", D), ("total_revenue", D), ("revenue_per_customer", D),
    ("control_conversion_rate", D), ("absolute_lift", D), ("relative_lift_pct", D),
    ("incremental_revenue", D), ("p_value", D), ("ci_lower", D), ("ci_upper", D),
    ("statistically_significant", B),
)
MART_FORECAST_RESULTS = _struct(
    ("event_date", DT), ("event_hour", I), ("actual_clicks", L), ("forecast_clicks", D),
    ("actual_ctr", D), ("forecast_ctr", D), ("model_name", S), ("mae", D), ("rmse", D),
    ("mape", D),
)
RECOMMENDATIONS = _struct(("channel", S), ("segment", S), ("metric", S), ("action", S),
                          ("evidence", S), ("caveat", S))
VALIDATION_CHECKS = _struct(("check_order", I), ("check_name", S), ("status", S),
                            ("expected", S), ("actual", S), ("message", S))

# Table registry: name -> (layer, schema).  The ten contracts of the warehouse.
TABLES = {
    "raw_avazu_ads": ("raw", RAW_ADS),
    "raw_hillstrom_email": ("raw", RAW_EXPERIMENT),
    "stg_ad_events": ("staging", STG_ADS),
    "stg_email_experiment": ("staging", STG_EXPERIMENT),
    "mart_campaign_kpis": ("mart", MART_CAMPAIGN_KPIS),
    "mart_ctr_trends": ("mart", MART_CTR_TRENDS),
    "mart_device_app_performance": ("mart", MART_SEGMENTS),
    "mart_ab_test_results": ("mart", MART_AB_RESULTS),
    "mart_forecast_inputs": ("mart", MART_FORECAST_INPUTS),
    "mart_forecast_results": ("mart", MART_FORECAST_RESULTS),
}
# -----------------------------------------------------------------------------------

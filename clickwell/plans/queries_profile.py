"""Registered profiling queries (P1-P14) over the raw adapters."""

from __future__ import annotations

from ..operators import profile as P
from ..schemas import ADS_RAW_COLUMNS, EXPERIMENT_RAW_COLUMNS
from ..sources.adapters import raw_ads, raw_experiment
from .oracle import binary, dbl, ratio, with_ctes
from .registry import register

ADS_VALID = f"ads_valid AS (SELECT * FROM ads_na WHERE {binary(dbl('click'))})"


def _ads(body: str) -> str:
    return with_ctes(["ads_prep"], body, [ADS_VALID])


def _exp(body: str) -> str:
    return with_ctes(["exp_prep"], body)


def _union(cols, src: str, value_expr: str = "CAST({c} AS VARCHAR)") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {value_expr.format(c=c)} AS value FROM {src}" for c in cols)


def _missing_sql(cols, src: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS missing_count, "
        f"count(*) AS n FROM {src}" for c in cols)
    return (f"SELECT column_name, missing_count, round(missing_count / n * 100, 2) AS missing_pct "
            f"FROM ({parts}) m WHERE missing_count > 0")


@register("profile_missing", _ads(_missing_sql(ADS_RAW_COLUMNS, "ads_valid")))
def profile_missing(spark, sf):
    return P.missing_summary(P.ads_valid_clicks(raw_ads(spark, sf)))


@register("profile_missing_experiment", _exp(_missing_sql(EXPERIMENT_RAW_COLUMNS, "exp_na")))
def profile_missing_experiment(spark, sf):
    return P.missing_summary(P._as_pandas_read(raw_experiment(spark, sf)))


_DATE = "CAST(_ts AS DATE)"
_V = f"coalesce({binary('_click')}, false)"


@register("profile_click_stats", with_ctes(["ads_prep"], f"""
SELECT 'avazu_mobile_ads' AS dataset, row_count, {len(ADS_RAW_COLUMNS)} AS column_count,
  no_click, click, invalid, round({ratio('click', 'row_count')}, 6) AS ctr,
  round({ratio('click', 'row_count')} * 100, 4) AS ctr_pct,
  min_event_date, max_event_date, distinct_days
FROM (SELECT
  CAST(sum(CASE WHEN {_V} THEN 1 ELSE 0 END) AS BIGINT) AS row_count,
  CAST(sum(CASE WHEN {_V} AND _click = 0 THEN 1 ELSE 0 END) AS BIGINT) AS no_click,
  CAST(sum(CASE WHEN {_V} AND _click = 1 THEN 1 ELSE 0 END) AS BIGINT) AS click,
  CAST(sum(CASE WHEN NOT {_V} THEN 1 ELSE 0 END) AS BIGINT) AS invalid,
  min(CASE WHEN {_V} THEN {_DATE} END) AS min_event_date,
  max(CASE WHEN {_V} THEN {_DATE} END) AS max_event_date,
  CAST(count(DISTINCT CASE WHEN {_V} THEN {_DATE} END) AS BIGINT) AS distinct_days
  FROM ads_prep) s"""))
def profile_click_stats(spark, sf):
    return P.ads_click_stats(raw_ads(spark, sf))


@register("profile_distinct", _ads(f"""
SELECT column_name, CAST(count(DISTINCT value) AS BIGINT) AS distinct_count
FROM ({_union(P.AD_DISTINCT_COLUMNS, 'ads_valid')}) u GROUP BY column_name"""))
def profile_distinct(spark, sf):
    return P.distinct_counts(P.ads_valid_clicks(raw_ads(spark, sf)), P.AD_DISTINCT_COLUMNS)


_NAN = "coalesce(CAST({c} AS VARCHAR), 'nan')"


@register("profile_top_values", _ads(f"""
SELECT column_name, value, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value ASC) AS rank
  FROM (SELECT column_name, value, CAST(count(*) AS BIGINT) AS count
        FROM ({_union(P.AD_TOP_COLUMNS, 'ads_valid', _NAN)}) u GROUP BY column_name, value) c
) r WHERE rank <= {P.TOP_K}"""))
def profile_top_values(spark, sf):
    return P.top_values(P.ads_valid_clicks(raw_ads(spark, sf)), P.AD_TOP_COLUMNS)


@register("profile_value_counts", _exp(f"""
SELECT column_name, value, CAST(count(*) AS BIGINT) AS count
FROM ({_union(('segment', 'zip_code', 'channel'), 'exp_na', _NAN)}) u
GROUP BY column_name, value"""))
def profile_value_counts(spark, sf):
    return P.value_counts(P._as_pandas_read(raw_experiment(spark, sf)),
                          ("segment", "zip_code", "channel"))


_Z = "coalesce({x}, 0.0)"


@register("profile_experiment", _exp(f"""
SELECT row_count, {len(EXPERIMENT_RAW_COLUMNS)} AS column_count, visits, conversions,
  round({ratio('visits', 'row_count')}, 6) AS visit_rate,
  round({ratio('visits', 'row_count')} * 100, 4) AS visit_rate_pct,
  round({ratio('conversions', 'row_count')}, 6) AS conversion_rate,
  round({ratio('conversions', 'row_count')} * 100, 4) AS conversion_rate_pct,
  no_visit, visit, no_conversion, conversion
FROM (SELECT CAST(count(*) AS BIGINT) AS row_count,
  CAST(sum(coalesce(_visit, 0.0)) AS BIGINT) AS visits,
  CAST(sum(coalesce(_conversion, 0.0)) AS BIGINT) AS conversions,
  CAST(sum(CASE WHEN coalesce(_visit, 0.0) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS no_visit,
  CAST(sum(CASE WHEN coalesce(_visit, 0.0) = 1 THEN 1 ELSE 0 END) AS BIGINT) AS visit,
  CAST(sum(CASE WHEN coalesce(_conversion, 0.0) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS no_conversion,
  CAST(sum(CASE WHEN coalesce(_conversion, 0.0) = 1 THEN 1 ELSE 0 END) AS BIGINT) AS conversion
  FROM exp_prep) s"""))
def profile_experiment(spark, sf):
    return P.experiment_overview(raw_experiment(spark, sf))


@register("profile_arms", _exp(f"""
SELECT segment, recipients, CAST(v AS BIGINT) AS visits,
  round({ratio('v', 'recipients')}, 6) AS visit_rate, CAST(c AS BIGINT) AS conversions,
  round({ratio('c', 'recipients')}, 6) AS conversion_rate, round(r, 2) AS total_revenue,
  round({ratio('r', 'recipients')}, 4) AS revenue_per_customer
FROM (SELECT segment, count(*) AS recipients, sum(coalesce(_visit, 0.0)) AS v,
             sum(coalesce(_conversion, 0.0)) AS c, sum(coalesce(_spend, 0.0)) AS r
      FROM exp_prep WHERE segment IS NOT NULL GROUP BY segment) g"""))
def profile_arms(spark, sf):
    return P.arm_profile(raw_experiment(spark, sf))


@register("profile_distribution", _exp("""
SELECT 'spend' AS column_name, count(x) AS n, min(x) AS min, max(x) AS max,
  round(avg(x), 4) AS mean, median(x) AS median,
  CASE WHEN count(x) = 1 THEN 0.0 ELSE round(stddev_samp(x), 4) END AS std
FROM (SELECT coalesce(_spend, 0.0) AS x FROM exp_prep) t"""))
def profile_distribution(spark, sf):
    return P.revenue_distribution(raw_experiment(spark, sf))

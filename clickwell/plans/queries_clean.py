"""Registered cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean
from ..schemas import FLAG_COLUMNS, STG_ADS, STG_EXPERIMENT
from ..sources.adapters import raw_ads, raw_experiment
from .oracle import with_ctes
from .registry import register


@register("clean_ads", with_ctes(["stg_ads"], "SELECT * FROM stg_ads"))
def clean_ads(spark, sf):
    return clean.clean_ads(raw_ads(spark, sf))


def _COLUMNS(schema):
    return "[" + ", ".join(f"'{f.name}'" for f in schema.fields) + "]"


_UNKNOWN = ",\n  ".join(
    f"CAST(sum(CASE WHEN _valid_click AND _valid_hour AND flag_unknown_{c} THEN 1 ELSE 0 END)"
    f" AS BIGINT) AS unknown_{c}" for c in FLAG_COLUMNS)


@register("clean_ads_summary", with_ctes(["ads_prep"], f"""
SELECT 'avazu_mobile_ads' AS dataset,
  CAST(count(*) AS BIGINT) AS input_rows,
  CAST(sum(CASE WHEN _valid_click AND _valid_hour THEN 1 ELSE 0 END) AS BIGINT) AS output_rows,
  CAST(sum(CASE WHEN NOT _valid_click THEN 1 ELSE 0 END) AS BIGINT) AS dropped_invalid_click,
  CAST(sum(CASE WHEN _valid_click AND NOT _valid_hour THEN 1 ELSE 0 END) AS BIGINT)
    AS dropped_invalid_hour,
  CAST(sum(CASE WHEN _valid_click AND _valid_hour AND flag_missing_fields THEN 1 ELSE 0 END)
    AS BIGINT) AS rows_with_unknown_fields,
  {_UNKNOWN},
  min(CASE WHEN _valid_click AND _valid_hour THEN CAST(_ts AS DATE) END) AS min_event_date,
  max(CASE WHEN _valid_click AND _valid_hour THEN CAST(_ts AS DATE) END) AS max_event_date,
  CAST(count(DISTINCT CASE WHEN _valid_click AND _valid_hour THEN CAST(_ts AS DATE) END)
    AS BIGINT) AS distinct_days,
  CAST(count(*) - sum(CASE WHEN _valid_click AND _valid_hour THEN 1 ELSE 0 END) AS BIGINT)
    AS rows_removed,
  CASE WHEN sum(CASE WHEN _valid_click AND _valid_hour THEN 1 ELSE 0 END) = 0 THEN 0.0
       ELSE round(sum(CASE WHEN _valid_click AND _valid_hour AND _click = 1 THEN 1 ELSE 0 END)
                  / sum(CASE WHEN _valid_click AND _valid_hour THEN 1 ELSE 0 END), 6) END AS ctr,
  {_COLUMNS(STG_ADS)} AS columns
FROM ads_prep"""))
def clean_ads_summary(spark, sf):
    return clean.clean_ads_summary(raw_ads(spark, sf))


_FLAG_UNION = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CAST(flag_unknown_{c} AS INTEGER)) AS BIGINT) "
    f"AS unknown_rows FROM stg_ads" for c in FLAG_COLUMNS)


@register("unknown_flags", with_ctes(["stg_ads"], _FLAG_UNION + """
UNION ALL SELECT 'flag_missing_fields' AS column_name,
  CAST(sum(CAST(flag_missing_fields AS INTEGER)) AS BIGINT) AS unknown_rows FROM stg_ads"""))
def unknown_flags(spark, sf):
    return clean.unknown_flags(raw_ads(spark, sf))


@register("clean_experiment", with_ctes(["stg_exp"], "SELECT * FROM stg_exp"))
def clean_experiment(spark, sf):
    return clean.clean_experiment(raw_experiment(spark, sf))


_KEPT = "(NOT (_bad_visit OR _bad_conversion OR _bad_spend) AND treatment_group IS NOT NULL)"
_VALID = "(NOT (_bad_visit OR _bad_conversion OR _bad_spend))"


def _n(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def _rate(num: str, digits: int) -> str:
    return (f"CASE WHEN {_n(_KEPT)} = 0 THEN 0.0 ELSE round(({num}) / {_n(_KEPT)}, {digits}) END")


@register("clean_experiment_summary", with_ctes(["exp_prep"], f"""
SELECT CAST(count(*) AS BIGINT) AS input_rows,
  {_n(_KEPT)} AS output_rows,
  {_n('_bad_visit')} AS dropped_invalid_visit,
  {_n('_bad_conversion')} AS dropped_invalid_conversion,
  {_n('_bad_spend')} AS dropped_invalid_spend,
  {_n(_VALID + ' AND treatment_group IS NULL')} AS dropped_unmapped_segment,
  {_n(_KEPT + ' AND coalesce(zip_code != zip_code_std, true)')} AS zip_code_typo_rows,
  {_n(_KEPT + ' AND zip_code_std IS NULL')} AS rows_with_unknown_fields,
  'hillstrom_email_experiment' AS dataset,
  CAST(count(*) - {_n(_KEPT)} AS BIGINT) AS rows_removed,
  {_rate(_n(_KEPT + ' AND _visit = 1'), 6)} AS visit_rate,
  {_rate(_n(_KEPT + ' AND _conversion = 1'), 6)} AS conversion_rate,
  {_rate(f'sum(CASE WHEN {_KEPT} THEN _spend END)', 4)} AS revenue_mean,
  (SELECT string_agg(treatment_group || '=' || n, ',' ORDER BY treatment_group) FROM (
     SELECT treatment_group, count(*) AS n FROM exp_prep WHERE {_KEPT} GROUP BY treatment_group) g)
    AS treatment_group_counts,
  {_COLUMNS(STG_EXPERIMENT)} AS columns
FROM exp_prep"""))
def clean_experiment_summary(spark, sf):
    """The arm map as sorted text, which both engines can compare."""
    return clean.clean_experiment_summary(raw_experiment(spark, sf)).withColumn(
        "treatment_group_counts", F.array_join(F.array_sort(F.transform(
            F.map_entries("treatment_group_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ","))

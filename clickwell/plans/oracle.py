"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written from the operator semantics, not generated from the Spark plans.
Shared pieces are common table expressions: the two raw adapters, the cleaning
steps and the marts; each query is ``WITH <the CTEs it needs> SELECT ...``.
``pm(x, m)`` is a non-negative modulus (Spark ``pmod``; DuckDB ``%`` keeps the sign).
"""

from __future__ import annotations

from ..schemas import ADS_RAW_COLUMNS, EXPERIMENT_RAW_COLUMNS

# --- fixed values, stated here on their own so that an error in the library shows ------
NA_TOKENS = ["", "NA", "N/A", "n/a", "<NA>", "#N/A", "#N/A N/A", "#NA", "NULL", "null", "None", "nan", "NaN",
             "-nan", "-NaN", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN"]
UNKNOWN_STRINGS = ["", "nan", "null", "none", "unknown", "-1"]
SEGMENT_MAP = {"No E-Mail": "control", "Mens E-Mail": "mens_email", "Womens E-Mail": "womens_email"}
TREATMENT_LABELS = {"control": "Control (No E-Mail)", "mens_email": "Mens E-Mail", "womens_email": "Womens E-Mail"}
ZIP_CODE_MAP = {"Surburban": "Suburban", "Suburban": "Suburban", "Urban": "Urban", "Rural": "Rural"}
FLAG_COLUMNS = ["site_id", "site_domain", "site_category", "app_id", "app_domain", "app_category", "device_id",
                "device_model", "device_type"]
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
EXPORTS = (
    ("campaign_kpis.csv", "mart_campaign_kpis", "Campaign KPIs"),
    ("ctr_trends.csv", "mart_ctr_trends", "CTR trends"),
    ("segment_performance.csv", "mart_device_app_performance", "Segment performance"),
    ("ab_test_results.csv", "mart_ab_test_results", "A/B test results"),
    ("forecast_results.csv", "mart_forecast_results", "Forecast results"),
    ("recommendation_matrix.csv", "recommendations_summary",
     "Scale / pause / retest recommendation matrix"),
)
# ---------------------------------------------------------------------------------------


def pm(x: str, m: int) -> str:
    return f"((({x}) % {m} + {m}) % {m})"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def case_map(expr: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE NULL END)"


def na(c: str) -> str:
    return f"(CASE WHEN {c} IN {in_list(NA_TOKENS)} THEN NULL ELSE {c} END)"


# White space and numbers are stated here on their own, not taken from the library.
_SPACE = "'" + "".join(chr(i) for i in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                        0x2028, 0x2029, 0x202F, 0x205F, 0x3000]) + "'"
_NUMBER = r"'[+-]?(\d{1,200}(\.\d{0,200})?|\.\d{1,200})([eE][+-]?\d{1,2})?'"


def strip(c: str) -> str:
    return f"trim({c}, {_SPACE})"


def dbl(c: str) -> str:
    return f"(CASE WHEN regexp_full_match({strip(c)}, {_NUMBER}) THEN TRY_CAST({strip(c)} AS DOUBLE) END)"


def unknown_str(c: str) -> str:
    return f"({c} IS NULL OR lower({strip(c)}) IN {in_list(UNKNOWN_STRINGS)})"


def unknown_num(c: str) -> str:
    return f"({c} IS NULL OR coalesce({dbl(c)} = -1, false))"


def binary(c: str) -> str:
    return f"coalesce({c} IN (0, 1), false)"


def hour_ts(c: str) -> str:
    t = strip(c)
    return (f"(CASE WHEN regexp_full_match({t}, '[0-9]{{8}}') THEN "
            f"try_strptime((CASE WHEN CAST(substr({t}, 1, 2) AS INTEGER) >= 69 THEN '19' "
            f"ELSE '20' END) || {t}, '%Y%m%d%H') END)")


def ratio(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) = 0 THEN 0.0 ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END)"


# ------------------------------------------------------------------- raw adapters

_K = "TRY_CAST(regexp_extract(props, '\"k\":\\s*(-?[0-9]+)', 1) AS INTEGER)"
_CODE = "strftime(ts, '%y%m%d%H')"

RAW_ADS = f"""raw_ads AS (
  SELECT
    CAST(event_id AS VARCHAR) AS id,
    CASE WHEN {pm('event_id', 97)} = 13 THEN '9'
         WHEN {pm('event_id', 89)} = 7 THEN 'x'
         WHEN {pm('event_id', 101)} = 9 THEN '1d'
         WHEN {pm('event_id', 103)} = 9 THEN 'NAN'
         WHEN {pm('event_id', 107)} = 9 THEN chr(9) || '1.0' || chr(160)
         WHEN event_type = 'click' THEN '1' ELSE '0' END AS click,
    CASE WHEN {pm('event_id', 83)} = 5 THEN '99999999'
         WHEN {pm('event_id', 79)} = 3 THEN substr({_CODE}, 1, 7)
         ELSE {_CODE} END AS hour,
    '1005' AS c1,
    CASE WHEN {pm('event_id', 109)} = 3 THEN '1e12'
         ELSE CAST({pm('event_id', 2)} AS VARCHAR) END AS banner_pos,
    CASE WHEN {pm('event_id', 53)} = 1 THEN ''
         WHEN {pm('event_id', 53)} = 2 THEN ' Unknown '
         WHEN {pm('event_id', 53)} = 3 THEN NULL
         WHEN {pm('event_id', 53)} = 4 THEN '-1'
         WHEN {pm('event_id', 53)} = 5 THEN 'NA'
         WHEN {pm('event_id', 53)} = 6 THEN chr(9) || 'unknown' || chr(12)
         ELSE 'site_' || CAST({pm(_K, 16)} AS VARCHAR) END AS site_id,
    'dom_' || CAST({pm(_K, 8)} AS VARCHAR) AS site_domain,
    'site_' || CAST({pm(_K, 4)} AS VARCHAR) AS site_category,
    'app_id_' || CAST({pm('event_id', 7)} AS VARCHAR) AS app_id,
    'appdom_' || CAST({pm('event_id', 5)} AS VARCHAR) AS app_domain,
    'app_' || CAST({pm('event_id', 3)} AS VARCHAR) AS app_category,
    'dev_' || CAST(user_id AS VARCHAR) AS device_id,
    'ip_' || CAST({pm('user_id', 50)} AS VARCHAR) AS device_ip,
    'model_' || CAST({pm('user_id', 9)} AS VARCHAR) AS device_model,
    CASE WHEN {pm('event_id', 61)} = 7 THEN '-1'
         WHEN {pm('event_id', 113)} = 7 THEN 'NAN'
         ELSE CAST({pm('user_id', 4)} AS VARCHAR) END AS device_type,
    CASE WHEN {pm('event_id', 127)} = 7 THEN '2.5'
         ELSE CAST({pm('user_id', 3)} AS VARCHAR) END AS device_conn_type,
    CAST({_K} AS VARCHAR) AS c14,
    '320' AS c15,
    '50' AS c16,
    CAST({_K} * 10 AS VARCHAR) AS c17,
    CAST({pm('user_id', 4)} AS VARCHAR) AS c18,
    '35' AS c19,
    CAST({pm('event_id', 100)} AS VARCHAR) AS c20,
    CAST(value AS VARCHAR) AS c21
  FROM events
)"""


def raw_experiment_cte(variant: str = "plain") -> str:
    urgent = "o_orderpriority = '1-URGENT'"
    if variant == "plain":
        hit = f"({urgent} AND o_orderstatus = 'F')"
    else:
        arm = pm("o_custkey", 3)
        hit = (f"(CASE WHEN {arm} = 1 THEN {urgent} AND o_orderstatus IN ('F', 'O') "
               f"WHEN {arm} = 2 THEN {urgent} AND o_orderstatus = 'F' AND o_totalprice > 200000 "
               f"ELSE {urgent} AND o_orderstatus = 'F' END)")
    return f"""per_customer AS (
  SELECT o_custkey,
         max(CASE WHEN {hit} THEN 1 ELSE 0 END) AS any_visit,
         max(CASE WHEN {hit} AND o_totalprice > 300000 THEN 1 ELSE 0 END) AS any_conv,
         sum(CASE WHEN {hit} THEN CAST(o_totalprice AS DECIMAL(18,2))
                  ELSE CAST(0 AS DECIMAL(18,2)) END) AS spend_total
  FROM orders GROUP BY o_custkey
),
raw_experiment AS (
  SELECT
    CAST({pm('c_custkey', 12)} + 1 AS VARCHAR) AS recency,
    CASE WHEN {pm('c_custkey', 3)} = 0 THEN '1) $0 - $100'
         WHEN {pm('c_custkey', 3)} = 1 THEN '2) $100 - $200'
         ELSE '3) $200 - $350' END AS history_segment,
    CAST(abs(c_acctbal) AS VARCHAR) AS history,
    CAST({pm('c_custkey', 2)} AS VARCHAR) AS mens,
    CAST({pm('c_nationkey', 2)} AS VARCHAR) AS womens,
    CASE WHEN {pm('c_custkey', 211)} = 5 THEN 'Mars'
         WHEN {pm('c_nationkey', 4)} = 0 THEN 'Urban'
         WHEN {pm('c_nationkey', 4)} = 1 THEN 'Suburban'
         WHEN {pm('c_nationkey', 4)} = 2 THEN 'Rural'
         ELSE 'Surburban' END AS zip_code,
    CASE WHEN {pm('c_custkey', 5)} = 0 THEN '1' ELSE '0' END AS newbie,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Web'
         WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Phone'
         WHEN {pm('c_custkey', 127)} = 31 THEN 'N/A'
         ELSE 'Multichannel' END AS channel,
    CASE WHEN {pm('c_custkey', 107)} = 11 THEN 'Both E-Mail'
         WHEN {pm('c_custkey', 3)} = 0 THEN 'No E-Mail'
         WHEN {pm('c_custkey', 3)} = 1 THEN 'Mens E-Mail'
         ELSE 'Womens E-Mail' END AS segment,
    CASE WHEN {pm('c_custkey', 103)} = 17 THEN '2'
         ELSE CAST(coalesce(any_visit, 0) AS VARCHAR) END AS visit,
    CASE WHEN {pm('c_custkey', 109)} = 19 THEN '1f'
         ELSE CAST(coalesce(any_conv, 0) AS VARCHAR) END AS conversion,
    CASE WHEN {pm('c_custkey', 101)} = 23 THEN '-5.0'
         WHEN {pm('c_custkey', 113)} = 29 THEN 'NAN'
         ELSE CAST(coalesce(spend_total, CAST(0 AS DECIMAL(18,2))) AS VARCHAR) END AS spend
  FROM customer LEFT JOIN per_customer ON c_custkey = o_custkey
)"""


# ------------------------------------------------------------------- cleaning

_ADS_NA = ", ".join(f"{na(c)} AS {c}" for c in ADS_RAW_COLUMNS)
_FLAGS = ",\n    ".join(
    f"{unknown_num(c) if c == 'device_type' else unknown_str(c)} AS flag_unknown_{c}"
    for c in FLAG_COLUMNS)
_ANY_FLAG = " OR ".join(f"flag_unknown_{c}" for c in FLAG_COLUMNS)

ADS_PREP = f"""ads_na AS (SELECT {_ADS_NA} FROM raw_ads),
ads_prep0 AS (
  SELECT *, {dbl('click')} AS _click, {hour_ts('hour')} AS _ts,
    {_FLAGS}
  FROM ads_na
),
ads_prep AS (
  SELECT *, {binary('_click')} AS _valid_click, _ts IS NOT NULL AS _valid_hour,
         ({_ANY_FLAG}) AS flag_missing_fields
  FROM ads_prep0
)"""

_INT_COLS = {"banner_pos", "device_conn_type"}
_NUM = ",\n    ".join(
    f"TRY_CAST({dbl(c)} AS INTEGER) AS {c}" if c in _INT_COLS else f"{dbl(c)} AS {c}"
    for c in ("banner_pos", "device_conn_type", "c14", "c15", "c16", "c17", "c18", "c19",
              "c20", "c21"))

STG_ADS = f"""stg_ads AS (
  SELECT id, CAST(_click AS INTEGER) AS click, CAST({strip('hour')} AS BIGINT) AS hour,
    TRY_CAST({dbl('c1')} AS BIGINT) AS c1,
    site_id, site_domain, site_category, app_id, app_domain, app_category,
    device_id, device_ip, device_model,
    TRY_CAST({dbl('device_type')} AS INTEGER) AS device_type,
    {_NUM},
    CAST(_ts AS DATE) AS event_date, CAST(hour(_ts) AS INTEGER) AS event_hour,
    {", ".join(f"flag_unknown_{c}" for c in FLAG_COLUMNS)}, flag_missing_fields
  FROM ads_prep WHERE _valid_click AND _valid_hour
)"""

_EXP_NA = ", ".join(f"{na(c)} AS {c}" for c in EXPERIMENT_RAW_COLUMNS)
EXP_PREP = f"""exp_na AS (SELECT {_EXP_NA} FROM raw_experiment),
exp_prep0 AS (
  SELECT *, {dbl('visit')} AS _visit, {dbl('conversion')} AS _conversion,
         {dbl('spend')} AS _spend,
         {case_map('segment', SEGMENT_MAP)} AS treatment_group,
         {case_map('zip_code', ZIP_CODE_MAP)} AS zip_code_std
  FROM exp_na
),
exp_prep AS (
  SELECT *, NOT {binary('_visit')} AS _bad_visit, NOT {binary('_conversion')} AS _bad_conversion,
         NOT coalesce(_spend >= 0, false) AS _bad_spend
  FROM exp_prep0
)"""

STG_EXP = f"""stg_exp AS (
  SELECT CAST({dbl('recency')} AS INTEGER) AS recency, history_segment,
    CAST({strip('history')} AS DOUBLE) AS history,
    CAST({dbl('mens')} AS INTEGER) AS mens,
    CAST({dbl('womens')} AS INTEGER) AS womens, zip_code,
    CAST({dbl('newbie')} AS INTEGER) AS newbie, channel, segment,
    CAST(_visit AS INTEGER) AS visit, CAST(_conversion AS INTEGER) AS conversion,
    _spend AS spend, treatment_group,
    {case_map('treatment_group', TREATMENT_LABELS)} AS treatment_label,
    CAST(_visit AS INTEGER) AS converted, _spend AS revenue, zip_code_std,
    coalesce(zip_code != zip_code_std, true) AS flag_zip_code_typo,
    zip_code_std IS NULL AS flag_missing_fields
  FROM exp_prep
  WHERE NOT (_bad_visit OR _bad_conversion OR _bad_spend) AND treatment_group IS NOT NULL
)"""

# ------------------------------------------------------------------- marts

DAILY = f"""daily AS (
  SELECT event_date, CAST(count(*) AS BIGINT) AS impressions,
         CAST(sum(click) AS BIGINT) AS clicks,
         {ratio('sum(click)', 'count(*)')} AS ctr
  FROM stg_ads WHERE event_date IS NOT NULL GROUP BY event_date
)"""

HOURLY = f"""hourly AS (
  SELECT event_date, event_hour, CAST(count(*) AS BIGINT) AS impressions,
         CAST(sum(click) AS BIGINT) AS clicks,
         {ratio('sum(click)', 'count(*)')} AS ctr
  FROM stg_ads WHERE event_date IS NOT NULL AND event_hour IS NOT NULL
  GROUP BY event_date, event_hour
)"""

SEGMENTS = f"""seg0 AS (
  SELECT device_type, app_category, site_category, banner_pos,
         CAST(count(*) AS BIGINT) AS impressions, CAST(sum(click) AS BIGINT) AS clicks,
         {ratio('sum(click)', 'count(*)')} AS ctr
  FROM stg_ads GROUP BY device_type, app_category, site_category, banner_pos
),
total_clicks AS (SELECT CAST(coalesce(sum(clicks), 0) AS BIGINT) AS total FROM seg0),
segments AS (
  SELECT seg0.*, {ratio('clicks', 'total')} AS click_share FROM seg0 CROSS JOIN total_clicks
)"""

CTES = {
    "raw_ads": RAW_ADS, "ads_prep": ADS_PREP, "stg_ads": STG_ADS,
    "raw_experiment": raw_experiment_cte("plain"),
    "raw_experiment_contrast": raw_experiment_cte("contrast"),
    "exp_prep": EXP_PREP, "stg_exp": STG_EXP,
    "daily": DAILY, "hourly": HOURLY, "segments": SEGMENTS,
}
_DEPS = {
    "ads_prep": ["raw_ads"], "stg_ads": ["ads_prep"],
    "exp_prep": ["raw_experiment"], "stg_exp": ["exp_prep"],
    "daily": ["stg_ads"], "hourly": ["stg_ads"], "segments": ["stg_ads"],
}


def with_ctes(names: list[str], body: str, extra: list[str] | None = None) -> str:
    """``WITH`` the named CTEs (and their dependencies, in order) plus ``extra``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _DEPS.get(n, []):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [CTES[n] for n in order] + (extra or [])
    return "WITH " + ",\n".join(parts) + "\n" + body


def contrast(sql: str) -> str:
    """Swap the plain experiment adapter for the contrast variant."""
    return sql.replace(CTES["raw_experiment"], CTES["raw_experiment_contrast"])

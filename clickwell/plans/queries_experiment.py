"""Registered experiment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CONTROL_GROUP, SIGNIFICANCE_ALPHA
from ..functions.stats import critical_z
from ..operators import experiment as X
from ..session import write_shared
from . import inputs
from .oracle import contrast, ratio, with_ctes
from .registry import register

ZCRIT = f"CAST('{critical_z(SIGNIFICANCE_ALPHA)!r}' AS DOUBLE)"
CTRL = f"'{CONTROL_GROUP}'"

ARMS = f"""arms AS (
  SELECT treatment_group, treatment_label, recipients, conversions,
         {ratio('conversions', 'recipients')} AS conversion_rate, total_revenue,
         {ratio('total_revenue', 'recipients')} AS revenue_per_customer
  FROM (SELECT treatment_group, max(treatment_label) AS treatment_label,
               CAST(count(*) AS BIGINT) AS recipients,
               CAST(sum(converted) AS BIGINT) AS conversions,
               CAST(sum(CAST(revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue
        FROM stg_exp GROUP BY treatment_group) g
)"""

_N, _C = "CAST(a.recipients AS DOUBLE)", "CAST(c.recipients AS DOUBLE)"
_POOLED = (f"(CAST(a.conversions + c.conversions AS DOUBLE) / "
           f"CAST(a.recipients + c.recipients AS DOUBLE))")
_SE = f"sqrt((1.0 / {_N} + 1.0 / {_C}) * {_POOLED} * (1 - {_POOLED}))"
_DIFF = (f"(CAST(a.conversions AS DOUBLE) / {_N} - CAST(c.conversions AS DOUBLE) / {_C})")
_Z = (f"(CASE WHEN a.recipients > 0 AND c.recipients > 0 THEN "
      f"(CASE WHEN {_SE} > 0 THEN {_DIFF} / {_SE} END) END)")
_CI_SE = (f"sqrt(a.conversion_rate * (1 - a.conversion_rate) / {_N} "
          f"+ c.conversion_rate * (1 - c.conversion_rate) / {_C})")
_LIFT = "(a.conversion_rate - c.conversion_rate)"
_OK = "(a.recipients > 0 AND c.recipients > 0)"
_ISC = f"a.treatment_group = {CTRL}"

AB = f"""ab AS (
  SELECT a.treatment_group, a.treatment_label, a.recipients, a.conversions,
    a.conversion_rate, a.total_revenue, a.revenue_per_customer,
    c.conversion_rate AS control_conversion_rate,
    CASE WHEN {_ISC} THEN 0.0 ELSE {_LIFT} END AS absolute_lift,
    CASE WHEN {_ISC} OR c.conversion_rate = 0 THEN 0.0
         ELSE {_LIFT} / c.conversion_rate * 100.0 END AS relative_lift_pct,
    CASE WHEN {_ISC} THEN 0.0
         ELSE (a.revenue_per_customer - c.revenue_per_customer) * a.recipients
    END AS incremental_revenue,
    CASE WHEN {_ISC} THEN 0.0 WHEN {_OK} THEN {_LIFT} - {ZCRIT} * {_CI_SE} ELSE {_LIFT}
    END AS ci_lower,
    CASE WHEN {_ISC} THEN 0.0 WHEN {_OK} THEN {_LIFT} + {ZCRIT} * {_CI_SE} ELSE {_LIFT}
    END AS ci_upper,
    CASE WHEN {_ISC} THEN NULL ELSE {_Z} END AS z_score
  FROM arms a CROSS JOIN (SELECT * FROM arms WHERE treatment_group = {CTRL}) c
),
ab_sig AS (
  SELECT *, coalesce(treatment_group != {CTRL} AND abs(z_score) > {ZCRIT}, false)
           AS statistically_significant
  FROM ab
)"""


def _exp_sql(body: str, extra=("arms", "ab")) -> str:
    ext = {"arms": ARMS, "ab": AB}
    return with_ctes(["stg_exp"], body, [ext[e] for e in extra])


@register("arm_metrics", _exp_sql("SELECT * FROM arms", ("arms",)))
def arm_metrics(spark, sf):
    return X.arm_metrics(inputs.stg_experiment(spark, sf))


AB_LIFT_SQL = _exp_sql("SELECT * FROM ab_sig")


@register("ab_lift", AB_LIFT_SQL)
def ab_lift(spark, sf):
    return X.ab_results(inputs.stg_experiment(spark, sf), with_p_value=False, with_z=True)


@register("ab_lift_contrast", contrast(AB_LIFT_SQL))
def ab_lift_contrast(spark, sf):
    return X.ab_results(inputs.stg_experiment(spark, sf, "contrast"), with_p_value=False,
                        with_z=True)


@register("ab_summary", _exp_sql(f"""
SELECT CAST(count(*) AS BIGINT) AS mart_row_count,
       CAST(coalesce(sum(recipients), 0) AS BIGINT) AS total_recipients,
       CAST(coalesce(sum(conversions), 0) AS BIGINT) AS total_conversions,
       coalesce(string_agg(CASE WHEN statistically_significant AND treatment_group != {CTRL}
                                THEN treatment_group END, ','
                           ORDER BY CASE WHEN statistically_significant
                                         AND treatment_group != {CTRL}
                                         THEN treatment_group END), '') AS significant_treatments,
       (SELECT CAST(count(*) AS BIGINT) FROM stg_exp) AS staging_row_count,
       CAST('{SIGNIFICANCE_ALPHA!r}' AS DOUBLE) AS significance_alpha,
       round({ratio('coalesce(sum(conversions), 0)', 'coalesce(sum(recipients), 0)')}, 6)
         AS overall_conversion_rate,
       count(*) > 0 AND coalesce(sum(recipients), 0) = (SELECT count(*) FROM stg_exp) AS success
FROM ab_sig"""))
def ab_summary(spark, sf):
    stg = inputs.stg_experiment(spark, sf)
    rows = stg.agg(F.count(F.lit(1)).alias("staging_row_count"))
    return X.ab_summary(X.ab_results(stg, with_p_value=False), rows)


@register("scenario_lift", _exp_sql(f"""
SELECT s.treatment_group, s.conversion_rate AS scenario_rate,
  CASE WHEN s.treatment_group = {CTRL} THEN 0.0 ELSE s.conversion_rate - c.conversion_rate END
    AS scenario_absolute_lift,
  CASE WHEN s.treatment_group = {CTRL} THEN 0.0 WHEN c.conversion_rate = 0 THEN NULL
       ELSE (s.conversion_rate - c.conversion_rate) / c.conversion_rate END
    AS scenario_relative_lift
FROM arms s LEFT JOIN (SELECT conversion_rate FROM arms WHERE treatment_group = {CTRL}) c ON true
""", ("arms",)))
def scenario_lift(spark, sf):
    return X.scenario_lift(X.arm_metrics(inputs.stg_experiment(spark, sf)))


# --- p-values -----------------------------------------------------------------------
# DuckDB has no erfc.  The oracle takes p = erfc(x), x = |z| / sqrt(2), from the Taylor
# series of erf below x = 2 (absolute error under 1e-14) and from the continued fraction
# of erfc beyond (relative error under 1e-12).
import math as _math

_TERMS = " + ".join(
    f"CAST('{(-1) ** n / (_math.factorial(n) * (2 * n + 1))!r}' AS DOUBLE) * pow(xx, {2 * n + 1})"
    for n in range(45))
_FRACTION = "xx"
for _n in range(90, 0, -1):
    _FRACTION = f"(xx+{_n / 2!r}/{_FRACTION})"
_P = (f"(CASE WHEN xx < 2 THEN 1.0 - CAST('{2 / _math.sqrt(_math.pi)!r}' AS DOUBLE) * ({_TERMS}) "
      f"ELSE exp(-xx * xx) / (CAST('{_math.sqrt(_math.pi)!r}' AS DOUBLE) * {_FRACTION}) END)")
P_DIGITS = 10
AB_P = f"""ab_p AS (
  SELECT * EXCLUDE (xx, z_score, statistically_significant), CASE WHEN treatment_group = {CTRL} THEN NULL
         WHEN recipients = 0 THEN 1.0 WHEN z_score IS NULL THEN NULL ELSE {_P} END AS p_value,
         statistically_significant
  FROM (SELECT *, abs(z_score) / sqrt(2.0) AS xx FROM ab_sig) t
)"""


def _p_sql(body: str) -> str:
    return with_ctes(["stg_exp"], body, [ARMS, AB, AB_P])


@register("ab_pvalue", contrast(_p_sql(f"""
SELECT * REPLACE (round(p_value, {P_DIGITS}) AS p_value), round(ln(p_value), 6) AS ln_p FROM ab_p""")))
def ab_pvalue(spark, sf):
    """X11: the 15 columns of the mart, with p to ten places and its logarithm (two ways of
    computing p agree to about twelve digits, not to the last bit)."""
    r = X.ab_results(inputs.stg_experiment(spark, sf, "contrast"))
    return r.withColumns({"ln_p": F.round(F.log("p_value"), 6), "p_value": F.round("p_value", P_DIGITS)})


@register("ab_ordered", _p_sql(f"""
SELECT * REPLACE (round(p_value, {P_DIGITS}) AS p_value), CAST(row_number() OVER (ORDER BY
  CASE treatment_group WHEN 'control' THEN 1 WHEN 'mens_email' THEN 2 WHEN 'womens_email' THEN 3 ELSE 4 END,
  treatment_group) AS INTEGER) AS arm_order FROM ab_p"""))
def ab_ordered(spark, sf):
    """The results in arm order."""
    r = X.ordered_arms(X.ab_results(inputs.stg_experiment(spark, sf)))
    return r.withColumn("p_value", F.round("p_value", P_DIGITS))


_MATRIX_UNION = " UNION ALL ".join(
    f"SELECT {i} AS metric_order, '{label}' AS metric, treatment_group, round(CAST({col} AS DOUBLE), 10) AS value FROM ab_p"
    for i, (label, col) in enumerate(X.MATRIX_METRICS))
# One more arm than the configured three: the customers of one region, as a fourth arm.
_FOURTH = "CASE WHEN zip_code_std = 'Rural' AND treatment_group = 'womens_email' THEN 'womens_rural' ELSE treatment_group END"


@register("arm_matrix", _p_sql(f"""
SELECT metric_order, metric,
  max(CASE WHEN treatment_group = 'control' THEN value END) AS control,
  max(CASE WHEN treatment_group = 'mens_email' THEN value END) AS mens_email,
  max(CASE WHEN treatment_group = 'womens_email' THEN value END) AS womens_email,
  max(CASE WHEN treatment_group = 'womens_rural' THEN value END) AS womens_rural
FROM ({_MATRIX_UNION}) m GROUP BY metric_order, metric""").replace(
    "FROM stg_exp GROUP BY treatment_group", f"FROM (SELECT * REPLACE ({_FOURTH} AS treatment_group) FROM stg_exp) GROUP BY treatment_group"))
def arm_matrix(spark, sf):
    """X14 with an arm that is not in the configured list."""
    stg = inputs.stg_experiment(spark, sf).withColumn("treatment_group", F.expr(_FOURTH))
    m = X.arm_matrix(write_shared(X.ab_results(stg)))
    return m.select("metric_order", "metric", *[F.round(c, 10).alias(c) for c in m.columns[2:]])


SCENARIO = {"control": 0.05, "mens_email": 0.08, "womens_email": 0.04}


@register("scenario_given", "SELECT * FROM (VALUES " + ", ".join(
    f"('{a}', CAST('{r!r}' AS DOUBLE), CAST('{(0.0 if a == 'control' else r - SCENARIO['control'])!r}' AS DOUBLE), "
    f"CAST('{(0.0 if a == 'control' else (r - SCENARIO['control']) / SCENARIO['control'])!r}' AS DOUBLE))"
    for a, r in SCENARIO.items()) + ") s(treatment_group, scenario_rate, scenario_absolute_lift, scenario_relative_lift) "
    "WHERE treatment_group IN (SELECT treatment_group FROM (" + _exp_sql("SELECT treatment_group FROM arms", ("arms",)) + ") a)")
def scenario_given(spark, sf):
    """X13 with rates that a user names, for the arms that the experiment has."""
    arms = X.arm_metrics(inputs.stg_experiment(spark, sf))
    rates = F.create_map(*[F.lit(x) for kv in SCENARIO.items() for x in kv])
    return X.scenario_lift(arms, arms.select("treatment_group", rates[F.col("treatment_group")].alias("scenario_rate")).filter(
        "scenario_rate is not null"))


# --- X12 rounded rows with p-values --------------------------------------------------
_ROUND = {c: d for c, d in X.SUMMARY_DIGITS.items() if c != "p_value"}
_ROUNDED_SQL = _p_sql(f"""
SELECT treatment_group, treatment_label, recipients, conversions,
  {", ".join(f"round({c}, {d}) AS {c}" for c, d in _ROUND.items())},
  round(p_value, 6) AS p_value, statistically_significant
FROM ab_p""")


@register("ab_summary_rows", _ROUNDED_SQL)
def ab_summary_rows(spark, sf):
    """X12 rows as the run summary reports them (p from the erfc UDF, 6 dp)."""
    return X.ab_rounded(X.ab_results(inputs.stg_experiment(spark, sf)))


@register("ab_summary_rows_contrast", contrast(_ROUNDED_SQL))
def ab_summary_rows_contrast(spark, sf):
    return X.ab_rounded(X.ab_results(inputs.stg_experiment(spark, sf, "contrast")))

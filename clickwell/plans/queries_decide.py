"""Registered decision and presentation queries.

The recommendation inputs are the full pipeline on the driver tables: the daily
mart (portfolio CTR), segment rankings, the hourly mart, the experiment mart (the
``contrast`` variant, so that Scale, Pause and Retest all occur) and the forecast
metrics (24-hour holdout).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decide as R
from ..operators import experiment as X
from ..operators import forecast as FC
from ..operators import kpi, present
from . import inputs
from .oracle import contrast, ratio, with_ctes
from .queries_experiment import ARMS, AB
from .queries_forecast import HOLDOUT, forecast_ctes
from .queries_kpi import LIMIT, MIN_IMPRESSIONS, _DIMS_ORDER
from .registry import register


def _d(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _pct(c: str, digits: int) -> str:
    return f"printf('%.{digits}f%%', ({c}) * 100)"


# Normal tail for the p shown (4 significant digits) in evidence text: DuckDB has no
# erfc, so the oracle uses a Chebyshev fit with relative error below 1.2e-7.
_T = "(1.0 / (1.0 + 0.5 * (abs(z_score) / sqrt(2.0))))"
_ERFC_COEF = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807,
              -1.13520398, 1.48851587, -0.82215223, 0.17087277]
_poly = str(_ERFC_COEF[-1])
for _c in reversed(_ERFC_COEF[1:-1]):
    _poly = f"({_c} + {_T} * {_poly})"
P_APPROX = (f"(CASE WHEN z_score IS NOT NULL THEN {_T} * exp(-(abs(z_score) / sqrt(2.0)) * "
            f"(abs(z_score) / sqrt(2.0)) + {_ERFC_COEF[0]} + {_T} * {_poly}) END)")
_P4 = "coalesce(printf('%.4g', p_approx), 'nan')"

_LABEL = ("'device=' || coalesce(CAST(device_type AS VARCHAR), 'None') || ' | app=' || "
          "coalesce(app_category, 'None') || ' | site=' || coalesce(site_category, 'None') || "
          "' | banner=' || coalesce(CAST(banner_pos AS VARCHAR), 'None')")


def _rank_cte(name: str, direction: str) -> str:
    order = f"ctr {direction}, impressions DESC, {_DIMS_ORDER}"
    return f"""{name} AS (
  SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank
  FROM (SELECT * FROM segments WHERE impressions >= {MIN_IMPRESSIONS}
        ORDER BY {order} LIMIT {LIMIT}) t
)"""


DECIDE_CTES = [
    f"port AS (SELECT {ratio('sum(clicks)', 'sum(impressions)')} AS pctr FROM daily)",
    _rank_cte("top", "DESC"),
    _rank_cte("bottom", "ASC"),
    ARMS, AB,
    f"""abp AS (
  SELECT *, coalesce(treatment_group != 'control' AND abs(z_score) > {_d(1.959963984540054)},
                     false) AS statistically_significant,
         {P_APPROX} AS p_approx,
         CASE treatment_group WHEN 'control' THEN 1 WHEN 'mens_email' THEN 2
              WHEN 'womens_email' THEN 3 ELSE 4 END AS arm_rank
  FROM ab
)""",
] + forecast_ctes(HOLDOUT) + [
    f"""recs AS (
  SELECT 'Mobile display (Avazu)' AS channel, {_LABEL} AS segment, 'CTR' AS metric,
         'Scale' AS action,
         {_pct('ctr', 2)} || ' CTR on ' || format('{{:,}}', impressions) || ' impressions (' ||
           {_pct('click_share', 1)} || ' click share)' AS evidence,
         '{R.CAVEAT_SEGMENT_SCALE}' AS caveat, 1 AS rule_order, rank AS row_order
  FROM top CROSS JOIN port WHERE rank <= 3 AND ctr >= pctr * {_d(1.15)}
  UNION ALL
  SELECT 'Mobile display (Avazu)', {_LABEL}, 'CTR', 'Pause',
         {_pct('ctr', 2)} || ' CTR on ' || format('{{:,}}', impressions) || ' impressions vs ' ||
           {_pct('pctr', 2)} || ' portfolio CTR',
         '{R.CAVEAT_SEGMENT_PAUSE}', 2, rank
  FROM bottom CROSS JOIN port WHERE rank <= 3 AND ctr <= pctr * {_d(0.75)}
  UNION ALL
  SELECT 'Mobile display (Avazu)', printf('Hour %02d', event_hour), 'Hourly CTR', 'Scale',
         {_pct('ctr', 2)} || ' CTR with ' || format('{{:,}}', impressions) || ' impressions',
         '{R.CAVEAT_HOUR_SCALE}', 3, 1
  FROM (SELECT * FROM hourly ORDER BY ctr DESC, event_hour ASC, event_date ASC LIMIT 1) b
  UNION ALL
  SELECT 'Mobile display (Avazu)', printf('Hour %02d', event_hour), 'Hourly CTR', 'Pause',
         {_pct('ctr', 2)} || ' CTR with ' || format('{{:,}}', impressions) || ' impressions',
         '{R.CAVEAT_HOUR_PAUSE}', 4, 1
  FROM (SELECT * FROM hourly ORDER BY ctr ASC, event_hour ASC, event_date ASC LIMIT 1) w
       CROSS JOIN port WHERE ctr <= pctr * {_d(0.75)}
  UNION ALL
  SELECT 'Email (Hillstrom)', treatment_label, 'Visit conversion rate', act,
         CASE act
           WHEN 'Scale' THEN '+' || {_pct('absolute_lift', 2)} || ' absolute lift (' ||
             printf('%.1f', relative_lift_pct) || '% relative), p=' || {_P4} ||
             ', incremental revenue $' || format('{{:,.0f}}', incremental_revenue)
           WHEN 'Retest' THEN 'Lift ' || {_pct('absolute_lift', 2)} ||
             ' not significant at alpha 0.05 (p=' || {_P4} || ')'
           ELSE 'Negative lift ' || {_pct('absolute_lift', 2)} || ' vs control' END,
         '', 5, CAST(row_number() OVER (ORDER BY treatment_group) AS INTEGER)
  FROM (SELECT *, CASE WHEN statistically_significant AND absolute_lift > 0 THEN 'Scale'
                       WHEN NOT statistically_significant THEN 'Retest'
                       WHEN absolute_lift <= 0 THEN 'Pause' END AS act
        FROM abp WHERE treatment_group != 'control') a
  WHERE act IS NOT NULL
  UNION ALL
  SELECT 'Mobile display (Avazu)', 'Hourly click forecast', 'Forecast accuracy (MAPE)',
         CASE WHEN mape >= {_d(100.0)} THEN 'Retest' ELSE 'Scale' END,
         'Model ' || model_name || ': MAE=' || format('{{:,.1f}}', mae) || ', RMSE=' ||
           format('{{:,.1f}}', rmse) || ', MAPE=' || printf('%.1f', mape) || '%',
         '{R.CAVEAT_FORECAST}', 6, 1
  FROM metrics WHERE selected AND mape IS NOT NULL
)""",
    """action_counts AS (
  SELECT a.action, a.action_order, CAST(coalesce(c.n, 0) AS BIGINT) AS recommendation_count
  FROM (VALUES ('Scale', 0), ('Pause', 1), ('Retest', 2)) a(action, action_order)
  LEFT JOIN (SELECT action, count(*) AS n FROM recs GROUP BY action) c ON a.action = c.action
)""",
]


def _sql(body: str, variant: str = "contrast") -> str:
    sql = with_ctes(["daily", "hourly", "segments", "stg_exp"], body, DECIDE_CTES)
    return contrast(sql) if variant == "contrast" else sql


def _inputs(spark, sf, variant="contrast"):
    """Marts for the rules from one pass over each raw input (shared intermediates
    checkpointed once; see ``pipeline.build``)."""
    from ..config import RankingConfig
    from .pipeline import build
    from ..sources.adapters import raw_ads, raw_experiment
    b = build(raw_ads(spark, sf), raw_experiment(spark, sf, variant),
              RankingConfig(min_impressions=MIN_IMPRESSIONS, limit=LIMIT),
              holdout_hours=HOLDOUT, share=True).prefetch("rollup", "ab")
    return b.daily, b.hourly, b.segments, b.top, b.bottom, b.ab, b.forecast_metrics


def _recs(spark, sf, variant="contrast"):
    daily, hourly, seg, top, bottom, ab, met = _inputs(spark, sf, variant)
    return R.recommendations(kpi.portfolio(daily), top, bottom, hourly, ab, met)


@register("recommendations", _sql("SELECT * FROM recs"))
def recommendations(spark, sf):
    return _recs(spark, sf)


@register("recommendations_plain", _sql("SELECT * FROM recs", variant="plain"))
def recommendations_plain(spark, sf):
    return _recs(spark, sf, "plain")


@register("action_counts", _sql("SELECT * FROM action_counts"))
def action_counts(spark, sf):
    return R.action_counts(_recs(spark, sf))


@register("headline", _sql("""
SELECT 'top_segment' AS item, 1 AS item_order,
       concat_ws(' / ', app_category, site_category) AS segment,
       printf('%.2f%%', ctr * 100) || ' CTR on ' || format('{:,}', impressions) || ' impressions'
         AS detail
FROM top WHERE rank = 1
UNION ALL
SELECT * FROM (SELECT 'best_treatment', 1, treatment_label,
                      '+' || printf('%.2f%%', absolute_lift * 100) || ' absolute visit lift'
               FROM abp WHERE treatment_group != 'control'
               ORDER BY absolute_lift DESC, treatment_group LIMIT 1) b
UNION ALL
SELECT lower(action), CAST(item_order AS INTEGER), segment, evidence
FROM (SELECT *, row_number() OVER (PARTITION BY action ORDER BY rule_order, row_order)
                AS item_order
      FROM recs WHERE action IN ('Scale', 'Pause')) p
WHERE (action = 'Scale' AND item_order <= 3) OR (action = 'Pause' AND item_order <= 2)"""))
def headline(spark, sf):
    daily, hourly, seg, top, bottom, ab, met = _inputs(spark, sf)
    recs = R.recommendations(kpi.portfolio(daily), top, bottom, hourly, ab, met)
    return R.headline(recs, top, ab)


@register("kpi_cards", _sql("""
SELECT card_order, metric, value FROM (
  SELECT 0 AS card_order, 'Impressions' AS metric, format('{:,}', sum(impressions)) AS value
  FROM daily
  UNION ALL SELECT 1, 'Clicks', format('{:,}', sum(clicks)) FROM daily
  UNION ALL SELECT 2, 'Portfolio CTR', printf('%.2f', pctr * 100) || '%' FROM port
  UNION ALL SELECT 3, 'Recommendations', CAST(sum(recommendation_count) AS VARCHAR)
  FROM action_counts
  UNION ALL SELECT 4 + action_order, action || ' actions', CAST(recommendation_count AS VARCHAR)
  FROM action_counts) c"""))
def kpi_cards(spark, sf):
    daily, hourly, seg, top, bottom, ab, met = _inputs(spark, sf)
    recs = R.recommendations(kpi.portfolio(daily), top, bottom, hourly, ab, met)
    return present.kpi_cards(daily, R.action_counts(recs))


@register("hourly_chart", with_ctes(["hourly"], """
SELECT event_date, event_hour, ctr * 100 AS ctr_pct,
       impressions / CAST(1000.0 AS DOUBLE) AS impressions_k FROM hourly"""))
def hourly_chart(spark, sf):
    return present.hourly_chart(inputs.hourly(spark, sf))


@register("segment_chart", with_ctes(["segments"], f"""
SELECT device_type, app_category, site_category, banner_pos, impressions,
  'd' || coalesce(CAST(device_type AS VARCHAR), 'None') || ' | ' ||
    substr(coalesce(app_category, 'None'), 1, 8) || ' | ' ||
    substr(coalesce(site_category, 'None'), 1, 8) AS segment_label,
  ctr * 100 AS ctr_pct,
  CASE WHEN ctr >= p.pctr THEN 'above' ELSE 'below' END AS vs_portfolio
FROM (SELECT * FROM segments WHERE impressions >= {MIN_IMPRESSIONS}
      ORDER BY ctr DESC, impressions DESC, {_DIMS_ORDER} LIMIT 10) t
CROSS JOIN (SELECT {ratio('sum(clicks)', 'sum(impressions)')} AS pctr FROM segments) p"""))
def segment_chart(spark, sf):
    return present.segment_chart(inputs.segments(spark, sf), MIN_IMPRESSIONS)


@register("arm_chart", _sql("""
SELECT treatment_group, treatment_label, conversion_rate * 100 AS conversion_pct,
       CASE WHEN treatment_group != 'control' THEN absolute_lift * 100 END AS lift_pts,
       statistically_significant
FROM abp"""))
def arm_chart(spark, sf):
    return present.arm_chart(X.ab_results(inputs.stg_experiment(spark, sf, "contrast")))


@register("forecast_pairs", with_ctes(["hourly"], """
SELECT event_date, event_hour, model_name, mape, 'actual' AS series,
       CAST(actual_clicks AS DOUBLE) AS clicks FROM results
UNION ALL
SELECT event_date, event_hour, model_name, mape, 'forecast', forecast_clicks FROM results""",
    forecast_ctes(HOLDOUT)))
def forecast_pairs(spark, sf):
    return present.forecast_pairs(FC.run_forecast(inputs.hourly(spark, sf), HOLDOUT)[2])


@register("recommendation_summary", _sql(f"""
SELECT round({ratio('sum(clicks)', 'sum(impressions)')}, 6) AS overall_ctr,
       CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
       (SELECT count(*) FROM recs) AS recommendation_count,
       (SELECT string_agg(lower(action) || '=' || recommendation_count, ',' ORDER BY lower(action))
        FROM action_counts) AS action_counts,
       (SELECT count(*) FROM recs) > 0 AS success
FROM daily"""))
def recommendation_summary(spark, sf):
    """R11; the map of counts as sorted text, which both engines can compare."""
    daily, hourly, seg, top, bottom, ab, met = _inputs(spark, sf)
    port = kpi.portfolio(daily)
    s = R.recommendation_summary(R.recommendations(port, top, bottom, hourly, ab, met), port)
    return s.withColumn("action_counts", F.array_join(F.array_sort(F.transform(F.map_entries("action_counts"), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string")))), ","))

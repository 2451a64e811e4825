"""Registered forecast queries (F1-F11).  Holdout of 24 hours on the driver data
(30 days of hourly rows); ``forecast_results_1h`` uses the reference default of 1."""

from __future__ import annotations

from ..config import MOVING_AVERAGE_WINDOW, NAIVE_MODEL_NAME, PRIMARY_MODEL_NAME
from pyspark.sql import functions as F

from ..operators import forecast as FC
from . import inputs
from .oracle import with_ctes
from .registry import register

HOLDOUT = 24


def _lag_mean(c: str, w: int) -> str:
    lags = [f"lag({c}, {k}) OVER (ORDER BY t)" for k in range(w, 0, -1)]
    total = " + ".join(f"coalesce(CAST({x} AS DOUBLE), 0.0)" for x in lags)
    count = " + ".join(f"(CASE WHEN {x} IS NOT NULL THEN 1 ELSE 0 END)" for x in lags)
    return f"(CASE WHEN ({count}) > 0 THEN ({total}) / ({count}) END)"


def forecast_ctes(holdout: int) -> list[str]:
    return [f"""series AS (
  SELECT *, greatest(1, least({holdout}, n - 1)) AS h
  FROM (SELECT *, row_number() OVER (ORDER BY event_date, event_hour) AS t,
               count(*) OVER () AS n FROM hourly) s
),
feat AS (
  SELECT *, t > n - h AS is_holdout,
    {_lag_mean('clicks', MOVING_AVERAGE_WINDOW)} AS ma_clicks,
    {_lag_mean('ctr', MOVING_AVERAGE_WINDOW)} AS ma_ctr,
    max(CASE WHEN t = n - h THEN clicks END) OVER () AS last_clicks,
    max(CASE WHEN t = n - h THEN ctr END) OVER () AS last_ctr
  FROM series
),
cand AS (
  SELECT event_date, event_hour, CAST(clicks AS BIGINT) AS actual_clicks,
         ma_clicks AS forecast_clicks, ctr AS actual_ctr, ma_ctr AS forecast_ctr,
         '{PRIMARY_MODEL_NAME}' AS model_name, 0 AS model_rank,
         n - h AS train_hours, h AS holdout_hours
  FROM feat WHERE is_holdout
  UNION ALL
  SELECT event_date, event_hour, CAST(clicks AS BIGINT), CAST(last_clicks AS DOUBLE), ctr,
         last_ctr, '{NAIVE_MODEL_NAME}', 1, n - h, h
  FROM feat WHERE is_holdout
),
metrics AS (
  SELECT *, row_number() OVER (ORDER BY mae ASC NULLS LAST, model_rank) = 1 AS selected
  FROM (SELECT model_name, model_rank,
          round(avg(abs(CAST(actual_clicks AS DOUBLE) - forecast_clicks)), 6) AS mae,
          round(sqrt(avg((CAST(actual_clicks AS DOUBLE) - forecast_clicks)
                         * (CAST(actual_clicks AS DOUBLE) - forecast_clicks))), 6) AS rmse,
          round(avg(CASE WHEN actual_clicks != 0
                         THEN abs(CAST(actual_clicks AS DOUBLE) - forecast_clicks)
                              / CAST(actual_clicks AS DOUBLE) END) * 100.0, 6) AS mape,
          first(train_hours) AS train_hours, first(holdout_hours) AS holdout_hours
        FROM cand GROUP BY model_name, model_rank) m
),
results AS (
  SELECT c.event_date, c.event_hour, c.actual_clicks, c.forecast_clicks, c.actual_ctr,
         c.forecast_ctr, c.model_name, m.mae, m.rmse, m.mape
  FROM cand c JOIN metrics m ON c.model_name = m.model_name AND m.selected
)"""]


def _sql(body: str, holdout: int = HOLDOUT) -> str:
    return with_ctes(["hourly"], body, forecast_ctes(holdout))


@register("forecast_inputs", with_ctes(["hourly"], "SELECT * FROM hourly"))
def forecast_inputs(spark, sf):
    return inputs.hourly(spark, sf)


@register("forecast_candidates", _sql("""
SELECT event_date, event_hour, actual_clicks, forecast_clicks, actual_ctr, forecast_ctr,
       model_name, model_rank, train_hours, holdout_hours FROM cand"""))
def forecast_candidates(spark, sf):
    return FC.forecast_candidates(inputs.hourly(spark, sf), HOLDOUT)


@register("forecast_metrics", _sql("SELECT * FROM metrics"))
def forecast_metrics(spark, sf):
    return FC.forecast_metrics(FC.forecast_candidates(inputs.hourly(spark, sf), HOLDOUT))


@register("forecast_results", _sql("SELECT * FROM results"))
def forecast_results(spark, sf):
    return FC.run_forecast(inputs.hourly(spark, sf), HOLDOUT)[2]


@register("forecast_results_1h", _sql("SELECT * FROM results", holdout=1))
def forecast_results_1h(spark, sf):
    return FC.run_forecast(inputs.hourly(spark, sf), 1)[2]


@register("forecast_summary", with_ctes(["hourly", "stg_ads"], """
SELECT m.train_hours, m.holdout_hours, m.model_name AS selected_model, m.mae, m.rmse, m.mape,
       (SELECT CAST(count(*) AS BIGINT) FROM metrics) AS models_evaluated,
       (SELECT string_agg(concat_ws(' ', model_name, printf('%.6f', mae), printf('%.6f', rmse), printf('%.6f', mape)),
                          ', ' ORDER BY model_name) FROM metrics) AS model_metrics,
       (SELECT CAST(count(*) AS BIGINT) FROM results) AS results_row_count,
       (SELECT CAST(count(*) AS BIGINT) FROM hourly) AS input_row_count,
       (SELECT CAST(coalesce(sum(impressions), 0) AS BIGINT) FROM hourly) AS total_impressions,
       (SELECT CAST(count(*) AS BIGINT) FROM stg_ads) AS staging_row_count,
       (SELECT count(*) FROM hourly) >= 2 AND (SELECT count(*) FROM results) > 0
         AND (SELECT coalesce(sum(impressions), 0) FROM hourly) = (SELECT count(*) FROM stg_ads)
         AND m.mae IS NOT NULL AS success
FROM metrics m WHERE m.selected""", forecast_ctes(HOLDOUT)))
def forecast_summary(spark, sf):
    from ..operators import kpi
    roll = kpi.ad_rollup(inputs.stg_ads(spark, sf))
    from ..session import write_shared
    roll = write_shared(roll)          # one scan of staging feeds all four consumers
    hourly = kpi.hourly_from(roll)
    _, met, res = FC.run_forecast(hourly, HOLDOUT)
    s = FC.forecast_summary(met, res, hourly, kpi.staging_rows_from(roll))
    # the nested metrics as text, which both engines can compare
    return s.withColumn("model_metrics", F.array_join(F.transform("model_metrics", lambda m: F.concat_ws(
        " ", m["model_name"], *[F.format_string("%.6f", m[c]) for c in ("mae", "rmse", "mape")])), ", "))

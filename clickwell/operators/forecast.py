"""Hourly click forecast with holdout evaluation.

The input is the hourly KPI mart (one row per series and hour), so the event log is
reduced by the hash aggregation in ``kpi.hourly_trends`` before any window runs.
Windows are partitioned by ``series_cols`` (several series forecast in parallel);
with no series columns the whole mart is one series, whose length is the number of
hours covered (it grows with the time span, not with the event volume).

Models (walk-forward on actuals, as in the reference):
* moving average of up to ``window`` previous actual rows (train and earlier holdout);
* naive: the last training value held constant over the holdout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (DEFAULT_HOLDOUT_HOURS, MIN_SERIES_LENGTH, MOVING_AVERAGE_WINDOW,
                      NAIVE_MODEL_NAME, PRIMARY_MODEL_NAME)

ORDER_COLS = ("event_date", "event_hour")


def ordered_series(hourly: DataFrame, holdout_hours: int = DEFAULT_HOLDOUT_HOURS,
                   series_cols: tuple[str, ...] = (),
                   order_cols: tuple[str, ...] = ORDER_COLS) -> DataFrame:
    """F2 + F3: index ``t`` (1-based), length ``n``, clipped holdout ``h`` and the
    ``is_holdout`` flag (last ``h`` rows).  Fewer than two rows fails the job."""
    w = Window.partitionBy(*series_cols).orderBy(*order_cols)
    whole = Window.partitionBy(*series_cols)
    s = hourly.withColumns({"t": F.row_number().over(w), "n": F.count(F.lit(1)).over(whole)})
    n = F.when(F.col("n") < MIN_SERIES_LENGTH, F.raise_error(F.lit(
        f"Need at least {MIN_SERIES_LENGTH} hourly observations for forecasting")))\
        .otherwise(F.col("n"))
    h = F.greatest(F.lit(1), F.least(F.lit(int(holdout_hours)), F.col("n") - 1))
    return s.withColumns({"n": n, "h": h}).withColumn("is_holdout", F.col("t") > F.col("n") - F.col("h"))


def _trailing_mean(c: str, w: Window, window: int):
    """Mean of up to ``window`` previous values, summed oldest first (same float
    evaluation order as a left-to-right sum over the trailing sample)."""
    lags = [F.lag(c, k).over(w) for k in range(window, 0, -1)]
    total = lags[0].cast("double")
    total = F.coalesce(total, F.lit(0.0))
    for lg in lags[1:]:
        total = total + F.coalesce(lg.cast("double"), F.lit(0.0))
    count = sum((F.when(lg.isNotNull(), 1).otherwise(0) for lg in lags[1:]),
                F.when(lags[0].isNotNull(), 1).otherwise(0))
    return F.when(count > 0, total / count)


def forecast_candidates(hourly: DataFrame, holdout_hours: int = DEFAULT_HOLDOUT_HOURS,
                        window: int = MOVING_AVERAGE_WINDOW,
                        series_cols: tuple[str, ...] = ()) -> DataFrame:
    """F4 + F5: holdout rows of both models, long form (one row per model and hour)."""
    # lags share their window (and its sort) with the series index
    w = Window.partitionBy(*series_cols).orderBy(*ORDER_COLS)
    whole = Window.partitionBy(*series_cols)
    s = ordered_series(hourly.withColumns({"_ma_clicks": _trailing_mean("clicks", w, window),
                                           "_ma_ctr": _trailing_mean("ctr", w, window)}),
                       holdout_hours, series_cols)
    last = F.col("t") == F.col("n") - F.col("h")   # the last training row
    s = s.withColumns({"_last_clicks": F.max(F.when(last, F.col("clicks"))).over(whole),
                       "_last_ctr": F.max(F.when(last, F.col("ctr"))).over(whole)}).filter("is_holdout")
    models = F.array(
        F.struct(F.lit(PRIMARY_MODEL_NAME).alias("model_name"), F.lit(0).alias("model_rank"),
                 F.col("_ma_clicks").alias("forecast_clicks"), F.col("_ma_ctr").alias("forecast_ctr")),
        F.struct(F.lit(NAIVE_MODEL_NAME).alias("model_name"), F.lit(1).alias("model_rank"),
                 F.col("_last_clicks").cast("double").alias("forecast_clicks"),
                 F.col("_last_ctr").alias("forecast_ctr")),
    )
    out = s.select(*series_cols, *ORDER_COLS, "t", "n", "h",
                   F.col("clicks").cast("bigint").alias("actual_clicks"),
                   F.col("ctr").alias("actual_ctr"), F.explode(models).alias("m"))
    return out.select(*series_cols, *ORDER_COLS, "actual_clicks", "m.forecast_clicks",
                      "actual_ctr", "m.forecast_ctr", "m.model_name", "m.model_rank",
                      (F.col("n") - F.col("h")).alias("train_hours"),
                      F.col("h").alias("holdout_hours"))


def _error_aggs(a, f):
    err = a - f
    return {
        "mae": lambda agg: F.round(agg(F.abs(err)), 6),
        "rmse": lambda agg: F.round(F.sqrt(agg(err * err)), 6),
        "mape": lambda agg: F.round(agg(F.when(a != 0, F.abs(err) / a)) * 100.0, 6),
    }


def forecast_metrics(candidates: DataFrame, series_cols: tuple[str, ...] = ()) -> DataFrame:
    """F6-F8 (+F9 flag): MAE, RMSE, MAPE (%, zero actuals skipped, null if none left),
    all rounded to 6 dp, per model; ``selected`` marks the lowest MAE (ties -> the
    first-listed model, null MAE last)."""
    aggs = _error_aggs(F.col("actual_clicks").cast("double"), F.col("forecast_clicks"))
    m = candidates.groupBy(*series_cols, "model_name", "model_rank").agg(
        *[fn(F.avg).alias(name) for name, fn in aggs.items()],
        F.first("train_hours").alias("train_hours"),
        F.first("holdout_hours").alias("holdout_hours"),
    )
    w = Window.partitionBy(*series_cols).orderBy(F.col("mae").asc_nulls_last(), "model_rank")
    return m.withColumn("selected", F.row_number().over(w) == 1)


def forecast_results(candidates: DataFrame, series_cols: tuple[str, ...] = ()) -> DataFrame:
    """holdout rows of the selected model, metrics repeated on every row.

    Metrics and the selection are windows over the candidate rows (holdout hours x
    models per series) so the candidates are consumed once."""
    per_model = Window.partitionBy(*series_cols, "model_name", "model_rank")
    aggs = _error_aggs(F.col("actual_clicks").cast("double"), F.col("forecast_clicks"))
    c = candidates.withColumns({name: fn(lambda x: F.avg(x).over(per_model))
                                for name, fn in aggs.items()})
    pick = Window.partitionBy(*series_cols).orderBy(F.col("mae").asc_nulls_last(), "model_rank")
    return c.withColumn("_pick", F.dense_rank().over(pick)).filter(F.col("_pick") == 1).select(
        *series_cols, *ORDER_COLS, "actual_clicks", "forecast_clicks", "actual_ctr",
        "forecast_ctr", "model_name", "mae", "rmse", "mape")


def forecast_summary(metrics: DataFrame, results: DataFrame, hourly: DataFrame,
                     staging_rows: DataFrame) -> DataFrame:
    """one row: series length, result rows, hours, metrics of every model, selected
    model and its metrics, total input impressions and the reconciliation flag (series long enough,
    results present, input impressions == staging rows, MAE present).
    ``staging_rows`` is a one-row frame with column ``staging_row_count``."""
    sel = metrics.filter("selected").select(
        "train_hours", "holdout_hours", F.col("model_name").alias("selected_model"),
        "mae", "rmse", "mape")
    models = metrics.agg(F.count(F.lit(1)).alias("models_evaluated"), F.array_sort(F.collect_list(F.struct(
        "model_name", "mae", "rmse", "mape"))).alias("model_metrics"))
    rows = results.agg(F.count(F.lit(1)).alias("results_row_count"))
    series = hourly.agg(F.count(F.lit(1)).alias("input_row_count"),
                        F.coalesce(F.sum("impressions"), F.lit(0)).cast("bigint")
                        .alias("total_impressions"))
    out = (sel.crossJoin(F.broadcast(models)).crossJoin(F.broadcast(rows))
           .crossJoin(F.broadcast(series)).crossJoin(F.broadcast(staging_rows)))
    return out.withColumn("success", (F.col("input_row_count") >= MIN_SERIES_LENGTH)
                          & (F.col("results_row_count") > 0)
                          & (F.col("total_impressions") == F.col("staging_row_count"))
                          & F.col("mae").isNotNull())


def run_forecast(hourly: DataFrame, holdout_hours: int = DEFAULT_HOLDOUT_HOURS,
                 series_cols: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates, metrics and results from one hourly mart."""
    cand = forecast_candidates(hourly, holdout_hours, series_cols=series_cols)
    met = forecast_metrics(cand, series_cols)
    return cand, met, forecast_results(cand, series_cols)

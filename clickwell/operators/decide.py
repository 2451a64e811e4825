"""Decision rules (R1-R12): turn the marts into scale / pause / retest actions.

Every input is already aggregated (top / bottom rankings of <= k rows, the hourly
mart, one row per arm, one row per forecast model); each rule is a small filtered
projection and the rules are appended with ``unionByName`` in a fixed order carried
by ``rule_order`` / ``row_order``.  The portfolio CTR is a one-row broadcast.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ACTIONS, ExperimentConfig, RuleConfig
from ..functions.text import py_format, text_or_none, thousands

# --- fixed values that must equal the reference ----------------------------------
AD_CHANNEL = "Mobile display (Avazu)"
EMAIL_CHANNEL = "Email (Hillstrom)"
CAVEAT_SEGMENT_SCALE = "Competition subsample; validate on live inventory before budget shifts."
CAVEAT_SEGMENT_PAUSE = ("Confirm spend concentration before pausing; segment still has "
                        "material volume.")
CAVEAT_HOUR_SCALE = "Single-day sample; confirm hour-of-day pattern across more dates."
CAVEAT_HOUR_PAUSE = "Hour-level pauses should be tested before full daypart shutdown."
CAVEAT_FORECAST = "Single-day holdout only; use forecasts for directional planning."
# ----------------------------------------------------------------------------------

def segment_label(dims=("device_type", "app_category", "site_category", "banner_pos")) -> F.Column:
    """``device=.. | app=.. | site=.. | banner=..`` (null shown as None)."""
    d, a, s, b = (text_or_none(c) for c in dims)
    return F.concat(F.lit("device="), d, F.lit(" | app="), a, F.lit(" | site="), s,
                    F.lit(" | banner="), b)


_NUM = ("ctr", "impressions", "click_share", "pctr", "lift", "rel", "p", "inc", "mae", "rmse",
        "mape")


# --- fixed values that must equal the reference: evidence sentences ----------------
def _evidence_text(kind, v: dict, alpha: float) -> str:
    """Evidence sentence with Python number formatting (see ``functions.text``)."""
    def num(x):
        return float("nan") if x is None or x != x else float(x)
    if kind == "segment_scale":
        return (f"{num(v['ctr']):.2%} CTR on {int(v['impressions']):,} impressions "
                f"({num(v['click_share']):.1%} click share)")
    if kind == "segment_pause":
        return (f"{num(v['ctr']):.2%} CTR on {int(v['impressions']):,} impressions "
                f"vs {num(v['pctr']):.2%} portfolio CTR")
    if kind == "hour":
        return f"{num(v['ctr']):.2%} CTR with {int(v['impressions']):,} impressions"
    if kind == "arm_scale":
        return (f"+{num(v['lift']):.2%} absolute lift ({num(v['rel']):.1f}% relative), "
                f"p={num(v['p']):.4g}, incremental revenue ${num(v['inc']):,.0f}")
    if kind == "arm_retest":
        return (f"Lift {num(v['lift']):.2%} not significant at alpha {alpha:g} "
                f"(p={num(v['p']):.4g})")
    if kind == "arm_pause":
        return f"Negative lift {num(v['lift']):.2%} vs control"
    if kind == "forecast":
        return (f"Model {v['model']}: MAE={num(v['mae']):,.1f}, RMSE={num(v['rmse']):,.1f}, "
                f"MAPE={num(v['mape']):.1f}%")
    return None
# ----------------------------------------------------------------------------------


def _evidence_udf(alpha: float):
    @F.pandas_udf(T.StringType())
    def evidence(kind: pd.Series, model: pd.Series, nums: pd.DataFrame) -> pd.Series:
        out = []
        for i in range(len(kind)):
            v = {name: nums[f"_{name}"].iloc[i] for name in _NUM}
            v["model"] = model.iloc[i]
            out.append(_evidence_text(kind.iloc[i], v, alpha))
        return pd.Series(out, dtype="object")
    return evidence


def _rows(df: DataFrame, rule: int, row_order, channel, segment, metric, action, kind,
          caveat, **values) -> DataFrame:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    nums = [values.get(n, F.lit(None)).cast("double").alias(f"_{n}") for n in _NUM]
    return df.select(lit(channel).alias("channel"), lit(segment).alias("segment"),
                     lit(metric).alias("metric"), lit(action).alias("action"),
                     lit(caveat).alias("caveat"), F.lit(rule).alias("rule_order"),
                     row_order.cast("int").alias("row_order"), lit(kind).alias("_kind"),
                     values.get("model", F.lit(None)).cast("string").alias("_model"), *nums)


def _best_hour(hourly: DataFrame, ascending: bool) -> DataFrame:
    ctr = F.col("ctr").asc() if ascending else F.col("ctr").desc()
    return hourly.orderBy(ctr, F.col("event_hour").asc(), F.col("event_date").asc()).limit(1)


def recommendations(portfolio_row: DataFrame, top: DataFrame, bottom: DataFrame,
                    hourly: DataFrame, ab: DataFrame, forecast_metrics: DataFrame,
                    rules: RuleConfig = RuleConfig(),
                    exp: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """R3-R10.  ``portfolio_row``: one row with ``ctr``; ``top`` / ``bottom``: ranked
    segments with ``rank``; ``ab``: experiment mart (with ``p_value`` and
    ``statistically_significant``); ``forecast_metrics``: per-model metrics with
    ``selected``.  Rule rows are appended first; the evidence text is then formatted
    in one vectorised pass over the (few) result rows."""
    port = F.broadcast(portfolio_row.select(F.col("ctr").alias("_portfolio_ctr")))
    pctr = F.col("_portfolio_ctr")
    c = F.col

    seg_scale = (top.filter(c("rank") <= rules.rule_candidates).crossJoin(port)
                 .filter(c("ctr") >= pctr * rules.scale_multiplier))
    seg_scale = _rows(seg_scale, 1, c("rank"), AD_CHANNEL, segment_label(), "CTR", "Scale",
                      "segment_scale", CAVEAT_SEGMENT_SCALE, ctr=c("ctr"),
                      impressions=c("impressions"), click_share=c("click_share"))
    seg_pause = (bottom.filter(c("rank") <= rules.rule_candidates).crossJoin(port)
                 .filter(c("ctr") <= pctr * rules.pause_multiplier))
    seg_pause = _rows(seg_pause, 2, c("rank"), AD_CHANNEL, segment_label(), "CTR", "Pause",
                      "segment_pause", CAVEAT_SEGMENT_PAUSE, ctr=c("ctr"),
                      impressions=c("impressions"), pctr=pctr)

    hour_label = F.format_string("Hour %02d", c("event_hour"))
    best = _rows(_best_hour(hourly, False), 3, F.lit(1), AD_CHANNEL, hour_label, "Hourly CTR",
                 "Scale", "hour", CAVEAT_HOUR_SCALE, ctr=c("ctr"), impressions=c("impressions"))
    worst = (_best_hour(hourly, True).crossJoin(port)
             .filter(c("ctr") <= pctr * rules.pause_multiplier))
    worst = _rows(worst, 4, F.lit(1), AD_CHANNEL, hour_label, "Hourly CTR", "Pause", "hour",
                  CAVEAT_HOUR_PAUSE, ctr=c("ctr"), impressions=c("impressions"))

    arms = ab.filter(c("treatment_group") != exp.control)
    sig, lift = c("statistically_significant"), c("absolute_lift")
    action = (F.when(sig & (lift > 0), F.lit("Scale")).when(~sig, F.lit("Retest"))
              .when(lift <= 0, F.lit("Pause")))
    kind = F.concat(F.lit("arm_"), F.lower(action))
    # arms are walked in name order (ties in the headline pick resolve the same way)
    arm_rows = _rows(arms.filter(action.isNotNull()), 5,
                     F.row_number().over(Window.orderBy("treatment_group")), EMAIL_CHANNEL,
                     c("treatment_label"), "Visit conversion rate", action, kind, "",
                     lift=lift, rel=c("relative_lift_pct"), p=c("p_value"),
                     inc=c("incremental_revenue"))

    fc = forecast_metrics.filter(c("selected") & c("mape").isNotNull())
    fc_action = F.when(c("mape") >= rules.mape_retest_threshold, F.lit("Retest")) \
        .otherwise(F.lit("Scale"))
    fc_rows = _rows(fc, 6, F.lit(1), AD_CHANNEL, "Hourly click forecast",
                    "Forecast accuracy (MAPE)", fc_action, "forecast", CAVEAT_FORECAST,
                    model=c("model_name"), mae=c("mae"), rmse=c("rmse"), mape=c("mape"))

    out = seg_scale
    for part in (seg_pause, best, worst, arm_rows, fc_rows):
        out = out.unionByName(part)
    evidence = _evidence_udf(exp.alpha)(c("_kind"), c("_model"),
                                        F.struct(*[c(f"_{n}") for n in _NUM]))
    return out.select("channel", "segment", "metric", "action", evidence.alias("evidence"),
                      "caveat", "rule_order", "row_order")


def action_counts(recs: DataFrame, actions: tuple[str, ...] = ACTIONS) -> DataFrame:
    """Count per action in the fixed action order, zero-filled."""
    dim = recs.sparkSession.createDataFrame(
        [(a, i) for i, a in enumerate(actions)], "action string, action_order int")
    counts = recs.groupBy("action").agg(F.count(F.lit(1)).alias("recommendation_count"))
    return (F.broadcast(dim).join(counts, "action", "left")
            .select("action", "action_order",
                    F.coalesce("recommendation_count", F.lit(0)).cast("bigint")
                    .alias("recommendation_count")))


def recommendation_summary(recs: DataFrame, portfolio_row: DataFrame,
                           actions: tuple[str, ...] = ACTIONS) -> DataFrame:
    """One row with the portfolio, the number of recommendations, their counts per
    action (zero-filled map, lower case) and ``success`` (there are any)."""
    counts = recs.agg(F.count(F.lit(1)).alias("recommendation_count"), F.create_map(*[x for a in actions for x in (
        F.lit(a.lower()), F.coalesce(F.sum(F.when(F.col("action") == a, 1)), F.lit(0)).cast("bigint"))]).alias("action_counts"))
    return portfolio_row.select(F.round("ctr", 6).alias("overall_ctr"), "impressions", "clicks").crossJoin(
        F.broadcast(counts)).withColumn("success", F.col("recommendation_count") > 0)


def headline(recs: DataFrame, top: DataFrame, ab: DataFrame,
             exp: ExperimentConfig = ExperimentConfig(), n_scale: int = 3,
             n_pause: int = 2) -> DataFrame:
    """Executive picks: the top segment, the arm with the largest lift (ties: arm
    order) and the first Scale / Pause recommendations in rule order."""
    w = Window.partitionBy("action").orderBy("rule_order", "row_order")
    picks = (recs.filter(F.col("action").isin("Scale", "Pause"))
             .withColumn("item_order", F.row_number().over(w))
             .filter(((F.col("action") == "Scale") & (F.col("item_order") <= n_scale))
                     | ((F.col("action") == "Pause") & (F.col("item_order") <= n_pause)))
             .select(F.lower("action").alias("item"), "item_order", "segment",
                     F.col("evidence").alias("detail")))
    top1 = top.filter(F.col("rank") == 1).select(
        F.lit("top_segment").alias("item"), F.lit(1).alias("item_order"),
        F.concat_ws(" / ", "app_category", "site_category").alias("segment"),
        F.concat(py_format("ctr", ".2%"), F.lit(" CTR on "), thousands("impressions"),
                 F.lit(" impressions")).alias("detail"))
    arms = ab.filter(F.col("treatment_group") != exp.control)
    best = arms.orderBy(F.col("absolute_lift").desc(), F.col("treatment_group")).limit(1).select(
        F.lit("best_treatment").alias("item"), F.lit(1).alias("item_order"),
        F.col("treatment_label").alias("segment"),
        F.concat(F.lit("+"), py_format("absolute_lift", ".2%"),
                 F.lit(" absolute visit lift")).alias("detail"))
    return top1.unionByName(best).unionByName(picks.withColumn("item_order",
                                                                F.col("item_order").cast("int")))

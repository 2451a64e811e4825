"""Presentation roll-ups (B1, B3-B7): the data behind KPI cards and charts.

All inputs are marts (already aggregated); rendering itself is out of scope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACTIONS, ExperimentConfig
from ..functions.text import py_format, thousands
from .kpi import portfolio


def kpi_cards(daily: DataFrame, counts: DataFrame, actions: tuple[str, ...] = ACTIONS) -> DataFrame:
    """B1: long (card_order, metric, value) table: impressions, clicks and CTR over
    all days, number of recommendations and the count per action."""
    p = portfolio(daily)
    c = counts.groupBy().pivot("action", list(actions)).agg(F.first("recommendation_count"))
    total = counts.agg(F.coalesce(F.sum("recommendation_count"), F.lit(0)).alias("_total"))
    row = p.crossJoin(F.broadcast(c)).crossJoin(F.broadcast(total))
    cards = [("Impressions", thousands("impressions")),
             ("Clicks", thousands("clicks")),
             ("Portfolio CTR", F.concat(py_format(F.col("ctr") * 100, ".2f"), F.lit("%"))),
             ("Recommendations", F.col("_total").cast("string"))]
    cards += [(f"{a} actions", F.coalesce(F.col(f"`{a}`"), F.lit(0)).cast("string"))
              for a in actions]
    arr = F.array(*[F.struct(F.lit(i).alias("card_order"), F.lit(name).alias("metric"),
                             val.alias("value")) for i, (name, val) in enumerate(cards)])
    return row.select(F.explode(arr).alias("c")).select("c.card_order", "c.metric", "c.value")


def hourly_chart(hourly: DataFrame) -> DataFrame:
    """Hourly CTR in percent and impressions in thousands."""
    return hourly.select("event_date", "event_hour", (F.col("ctr") * 100).alias("ctr_pct"),
                         (F.col("impressions") / 1000.0).alias("impressions_k"))


def segment_chart(seg: DataFrame, min_impressions: int, top_n: int = 10,
                  label_chars: int = 8) -> DataFrame:
    """Top-n segments by CTR with a short label and an above / below portfolio
    class (portfolio CTR computed from the segment mart, not hard-coded)."""
    port = F.broadcast(portfolio(seg).select(F.col("ctr").alias("_portfolio_ctr")))
    keys = [F.col("ctr").desc(), F.col("impressions").desc(), F.col("device_type").asc_nulls_first(),
            F.col("app_category").asc_nulls_first(), F.col("site_category").asc_nulls_first(),
            F.col("banner_pos").asc_nulls_first()]
    top = seg.filter(F.col("impressions") >= min_impressions).orderBy(*keys).limit(top_n).crossJoin(port)
    label = F.concat(F.lit("d"), F.coalesce(F.col("device_type").cast("string"), F.lit("None")),
                     F.lit(" | "), F.substring(F.coalesce("app_category", F.lit("None")), 1, label_chars),
                     F.lit(" | "), F.substring(F.coalesce("site_category", F.lit("None")), 1, label_chars))
    return top.select(
        "device_type", "app_category", "site_category", "banner_pos", "impressions",
        label.alias("segment_label"), (F.col("ctr") * 100).alias("ctr_pct"),
        F.when(F.col("ctr") >= F.col("_portfolio_ctr"), F.lit("above")).otherwise(F.lit("below"))
        .alias("vs_portfolio"))


def arm_chart(ab: DataFrame, cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """Conversion rate in percent per arm and lift in points (null for control)."""
    return ab.select("treatment_group", "treatment_label",
                     (F.col("conversion_rate") * 100).alias("conversion_pct"),
                     F.when(F.col("treatment_group") != cfg.control,
                            F.col("absolute_lift") * 100).alias("lift_pts"),
                     "statistically_significant")


def forecast_pairs(results: DataFrame) -> DataFrame:
    """Actual vs forecast clicks as long rows, with model and MAPE."""
    return results.select(
        "event_date", "event_hour", "model_name", "mape",
        F.explode(F.array(
            F.struct(F.lit("actual").alias("series"),
                     F.col("actual_clicks").cast("double").alias("clicks")),
            F.struct(F.lit("forecast").alias("series"), F.col("forecast_clicks").alias("clicks")),
        )).alias("p")).select("event_date", "event_hour", "model_name", "mape", "p.series",
                              "p.clicks")

"""Registered KPI / segment queries (A2-A10)."""

from __future__ import annotations


from ..operators import kpi
from . import inputs
from .oracle import ratio, with_ctes
from .registry import register

# The queries' explicit ranking threshold.  It is a parameter of the ranking (a segment
# needs this many impressions); the library's default is 1,000.
MIN_IMPRESSIONS = 100
LIMIT = 5
_DIMS_ORDER = ("device_type ASC NULLS FIRST, app_category ASC NULLS FIRST, "
               "site_category ASC NULLS FIRST, banner_pos ASC NULLS FIRST")


@register("daily_kpis", with_ctes(["daily"], "SELECT * FROM daily"))
def daily_kpis(spark, sf):
    return inputs.daily(spark, sf)


@register("hourly_trends", with_ctes(["hourly"], "SELECT * FROM hourly"))
def hourly_trends(spark, sf):
    return inputs.hourly(spark, sf)


@register("segment_performance", with_ctes(["segments"], "SELECT * FROM segments"))
def segment_performance(spark, sf):
    return inputs.segments(spark, sf)


@register("portfolio", with_ctes(["daily"], f"""
SELECT CAST(coalesce(sum(impressions), 0) AS BIGINT) AS impressions,
       CAST(coalesce(sum(clicks), 0) AS BIGINT) AS clicks,
       {ratio('coalesce(sum(clicks), 0)', 'coalesce(sum(impressions), 0)')} AS ctr
FROM daily"""))
def portfolio(spark, sf):
    return kpi.portfolio(inputs.daily(spark, sf))


def _ranking_sql(direction: str) -> str:
    order = f"ctr {direction}, impressions DESC, {_DIMS_ORDER}"
    return with_ctes(["segments"], f"""
SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank
FROM (SELECT * FROM segments WHERE impressions >= {MIN_IMPRESSIONS}
      ORDER BY {order} LIMIT {LIMIT}) t""")


@register("top_segments", _ranking_sql("DESC"))
def top_segments(spark, sf):
    return kpi.top_segments(inputs.segments(spark, sf), MIN_IMPRESSIONS, LIMIT)


@register("bottom_segments", _ranking_sql("ASC"))
def bottom_segments(spark, sf):
    return kpi.bottom_segments(inputs.segments(spark, sf), MIN_IMPRESSIONS, LIMIT)


@register("kpi_summary", with_ctes(["stg_ads"], f"""
SELECT CAST(sum(CASE WHEN event_date IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS mart_row_count,
       CAST(coalesce(sum(CASE WHEN event_date IS NOT NULL THEN impressions END), 0) AS BIGINT)
         AS total_impressions,
       CAST(coalesce(sum(CASE WHEN event_date IS NOT NULL THEN clicks END), 0) AS BIGINT)
         AS total_clicks,
       min(event_date) AS min_event_date, max(event_date) AS max_event_date,
       CAST(coalesce(sum(impressions), 0) AS BIGINT) AS staging_row_count,
       round({ratio('coalesce(sum(CASE WHEN event_date IS NOT NULL THEN clicks END), 0)',
                    'coalesce(sum(CASE WHEN event_date IS NOT NULL THEN impressions END), 0)')}, 6)
         AS overall_ctr,
       sum(CASE WHEN event_date IS NOT NULL THEN 1 ELSE 0 END) > 0
         AND coalesce(sum(CASE WHEN event_date IS NOT NULL THEN impressions END), 0)
             = coalesce(sum(impressions), 0) AS success
FROM (SELECT event_date, count(*) AS impressions, sum(click) AS clicks
      FROM stg_ads GROUP BY event_date) d"""))
def kpi_summary(spark, sf):
    return kpi.kpi_summary(inputs.stg_ads(spark, sf))


@register("hourly_range", with_ctes(["hourly", "segments"], f"""
SELECT h.*, s.*, r.staging_row_count,
       round({ratio('h.total_clicks', 'h.total_impressions')}, 6) AS overall_ctr,
       h.hourly_rows > 0 AND s.segment_rows > 0 AND h.total_impressions = r.staging_row_count
         AS success
FROM (SELECT CAST(count(*) AS BIGINT) AS hourly_rows,
             CAST(coalesce(sum(impressions), 0) AS BIGINT) AS total_impressions,
             CAST(coalesce(sum(clicks), 0) AS BIGINT) AS total_clicks,
             round(min(ctr), 6) AS min_hourly_ctr, round(max(ctr), 6) AS max_hourly_ctr
      FROM hourly) h
CROSS JOIN (SELECT CAST(count(*) AS BIGINT) AS segment_rows,
                   CAST(coalesce(sum(impressions), 0) AS BIGINT) AS segment_impressions
            FROM segments) s
CROSS JOIN (SELECT CAST(count(*) AS BIGINT) AS staging_row_count FROM stg_ads) r"""))
def hourly_range(spark, sf):
    return kpi.funnel_summary(kpi.ad_rollup(inputs.stg_ads(spark, sf)))


@register("daily_listing", with_ctes(["daily"], "SELECT event_date, impressions, clicks, round(ctr, 6) AS ctr FROM daily"))
def daily_listing(spark, sf):
    return kpi.daily_listing(inputs.daily(spark, sf))


def _ranking_rows(name: str, direction: str) -> str:
    order = f"ctr {direction}, impressions DESC, {_DIMS_ORDER}"
    return (f"SELECT '{name}' AS ranking, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, device_type, app_category, "
            f"site_category, banner_pos, impressions, clicks, round(ctr, 6) AS ctr, round(click_share, 6) AS click_share "
            f"FROM (SELECT * FROM segments WHERE impressions >= {MIN_IMPRESSIONS} ORDER BY {order} LIMIT {LIMIT})")


@register("segment_rankings", with_ctes(["segments"], "SELECT * FROM ({}) t UNION ALL SELECT * FROM ({}) b".format(
    _ranking_rows("top_by_ctr", "DESC"), _ranking_rows("bottom_by_ctr", "ASC"))))
def segment_rankings(spark, sf):
    """A10: both rankings as the funnel summary lists them."""
    seg = inputs.segments(spark, sf)
    return kpi.segment_rankings(kpi.top_segments(seg, MIN_IMPRESSIONS, LIMIT), kpi.bottom_segments(seg, MIN_IMPRESSIONS, LIMIT))

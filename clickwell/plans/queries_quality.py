"""Registered quality and table-management queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.kpi import empty_tables
from ..schemas import TABLES
from ..config import RankingConfig
from ..session import new_folder, write_shared
from ..sources.adapters import raw_ads, raw_experiment
from .pipeline import build, checks_of, export_all, lock_metrics_of, run_all, steps_of
from .oracle import CHECK_NAMES, contrast, ratio, with_ctes
from .queries_decide import DECIDE_CTES
from .queries_forecast import HOLDOUT
from .queries_kpi import LIMIT, MIN_IMPRESSIONS
from .registry import register

RANKING = RankingConfig(min_impressions=MIN_IMPRESSIONS, limit=LIMIT)


def bundle(spark, sf):
    """Staging written once from one pass over each raw input, the ad rollup and the
    experiment mart from one pass over staging; everything else reads those."""
    return build(raw_ads(spark, sf), raw_experiment(spark, sf, "contrast"), RANKING,
                 holdout_hours=HOLDOUT, share=True).staged(new_folder(spark, "staging")).prefetch("rollup", "ab")


def _f6(x: str) -> str:
    return f"printf('%.6f', round({x}, 6))"


_KEPT_ADS = "(_valid_click AND _valid_hour)"
_KEPT_EXP = "(NOT (_bad_visit OR _bad_conversion OR _bad_spend) AND treatment_group IS NOT NULL)"
TOL = "CAST('0.0001' AS DOUBLE)"

QUALITY_CTES = [
    f"""exp_summary AS (
  SELECT CAST(count(*) AS BIGINT) AS exp_exp_in,
         CAST(sum(CASE WHEN {_KEPT_EXP} THEN 1 ELSE 0 END) AS BIGINT) AS exp_exp_out,
         CASE WHEN sum(CASE WHEN {_KEPT_EXP} THEN 1 ELSE 0 END) = 0 THEN 0.0
              ELSE round(sum(CASE WHEN {_KEPT_EXP} AND _visit = 1 THEN 1 ELSE 0 END)
                         / sum(CASE WHEN {_KEPT_EXP} THEN 1 ELSE 0 END), 6) END AS exp_visit_rate
  FROM exp_prep
)""",
    f"""ads_summary AS (
  SELECT CAST(count(*) AS BIGINT) AS exp_ads_in,
         CAST(sum(CASE WHEN {_KEPT_ADS} THEN 1 ELSE 0 END) AS BIGINT) AS exp_ads_out,
         CASE WHEN sum(CASE WHEN {_KEPT_ADS} THEN 1 ELSE 0 END) = 0 THEN 0.0
              ELSE round(sum(CASE WHEN {_KEPT_ADS} AND _click = 1 THEN 1 ELSE 0 END)
                         / sum(CASE WHEN {_KEPT_ADS} THEN 1 ELSE 0 END), 6) END AS exp_ads_ctr
  FROM ads_prep
)""",
    """groups AS (
  SELECT (SELECT string_agg(s, ',' ORDER BY s) FROM
            (SELECT treatment_group || '=' || CAST(count(*) AS VARCHAR) AS s
             FROM exp_prep WHERE """ + _KEPT_EXP + """ GROUP BY treatment_group) e) AS exp_groups,
         (SELECT string_agg(s, ',' ORDER BY s) FROM
            (SELECT treatment_group || '=' || CAST(count(*) AS VARCHAR) AS s
             FROM stg_exp GROUP BY treatment_group) g) AS stg_groups,
         (SELECT string_agg(s, ',' ORDER BY s) FROM
            (SELECT treatment_group || '=' || CAST(recipients AS VARCHAR) AS s FROM abp) a)
           AS ab_groups
)""",
    """m AS (
  SELECT * FROM
    (SELECT count(*) AS raw_ads_rows FROM raw_ads) r1,
    (SELECT count(*) AS raw_exp_rows FROM raw_experiment) r2,
    (SELECT count(*) AS stg_ads_rows, avg(CAST(click AS DOUBLE)) AS stg_ads_ctr FROM stg_ads) s1,
    (SELECT count(*) AS stg_exp_rows, avg(CAST(visit AS DOUBLE)) AS stg_exp_visit_rate
     FROM stg_exp) s2,
    (SELECT count(*) AS daily_rows, coalesce(sum(impressions), 0) AS daily_impr,
            coalesce(sum(clicks), 0) AS daily_clicks FROM daily) d,
    (SELECT count(*) AS hourly_rows, coalesce(sum(impressions), 0) AS hourly_impr,
            coalesce(sum(clicks), 0) AS hourly_clicks FROM hourly) h,
    (SELECT count(*) AS seg_rows, coalesce(sum(impressions), 0) AS seg_impr,
            coalesce(sum(click_share), 0.0) AS seg_share FROM segments) sg,
    (SELECT count(*) AS ab_rows, coalesce(sum(recipients), 0) AS ab_recipients,
            coalesce(sum(conversions), 0) AS ab_conversions,
            sum(CASE WHEN treatment_group != 'control' AND (z_score IS NOT NULL OR
                      (conversion_rate = control_conversion_rate AND conversion_rate IN (0, 1)))
                     THEN 1 ELSE 0 END) AS ab_p_rows FROM abp) ab,
    (SELECT count(*) AS fres_rows,
            sum(CASE WHEN mae IS NOT NULL AND rmse IS NOT NULL AND model_name IS NOT NULL
                     THEN 1 ELSE 0 END) AS fres_metric_rows FROM results) fr,
    ads_summary, exp_summary, groups
)""",
]


def _c(i, name, ok, exp, act):
    return (f"SELECT {i} AS check_order, '{name}' AS check_name, "
            f"CASE WHEN coalesce({ok}, false) THEN 'pass' ELSE 'fail' END AS status, "
            f"CAST({exp} AS VARCHAR) AS expected, CAST({act} AS VARCHAR) AS actual FROM m")


def _approx(actual, expected, populated="true"):
    return f"({populated} AND abs(coalesce({actual}, 0.0) - {expected}) <= {TOL})"


_NG = "len(string_split(exp_groups, ','))"
_N = CHECK_NAMES
CHECK_ROWS = [
    _c(0, _N[0], "raw_ads_rows = exp_ads_in", "exp_ads_in", "raw_ads_rows"),
    _c(1, _N[1], "raw_exp_rows = exp_exp_in", "exp_exp_in", "raw_exp_rows"),
    _c(2, _N[2], "stg_ads_rows = exp_ads_out", "exp_ads_out", "stg_ads_rows"),
    _c(3, _N[3], "stg_exp_rows = exp_exp_out", "exp_exp_out", "stg_exp_rows"),
    _c(4, _N[4], _approx("stg_ads_ctr", "exp_ads_ctr"), _f6("exp_ads_ctr"),
       _f6("coalesce(stg_ads_ctr, 0.0)")),
    _c(5, _N[5], _approx("stg_exp_visit_rate", "exp_visit_rate"), _f6("exp_visit_rate"),
       _f6("coalesce(stg_exp_visit_rate, 0.0)")),
    _c(6, _N[6], "stg_groups = exp_groups", "exp_groups", "stg_groups"),
    _c(7, _N[7], "daily_rows > 0", "'> 0'", "daily_rows"),
    _c(8, _N[8], _approx(ratio("daily_clicks", "daily_impr"), "exp_ads_ctr", "daily_rows > 0"),
       _f6("exp_ads_ctr"), _f6(ratio("daily_clicks", "daily_impr"))),
    _c(9, _N[9], "hourly_rows > 0", "'> 0'", "hourly_rows"),
    _c(10, _N[10], "hourly_rows > 0 AND hourly_impr = exp_ads_out", "exp_ads_out", "hourly_impr"),
    _c(11, _N[11], _approx(ratio("hourly_clicks", "hourly_impr"), "exp_ads_ctr",
                           "hourly_rows > 0"),
       _f6("exp_ads_ctr"), _f6(ratio("hourly_clicks", "hourly_impr"))),
    _c(12, _N[12], "seg_rows > 0", "'> 0'", "seg_rows"),
    _c(13, _N[13], "seg_rows > 0 AND seg_impr = exp_ads_out", "exp_ads_out", "seg_impr"),
    _c(14, _N[14], _approx("seg_share", "1.0", "seg_rows > 0"), _f6("1.0"), _f6("seg_share")),
    _c(15, _N[15], f"ab_rows = {_NG}", _NG, "ab_rows"),
    _c(16, _N[16], f"ab_rows = {_NG} AND ab_groups = exp_groups", "exp_groups", "ab_groups"),
    _c(17, _N[17], f"ab_rows = {_NG} AND ab_recipients = exp_exp_out", "exp_exp_out",
       "ab_recipients"),
    _c(18, _N[18], _approx(ratio("ab_conversions", "ab_recipients"), "exp_visit_rate",
                           f"ab_rows = {_NG}"),
       _f6("exp_visit_rate"), _f6(ratio("ab_conversions", "ab_recipients"))),
    _c(19, _N[19], f"ab_rows = {_NG} AND ab_p_rows = {_NG} - 1", f"{_NG} - 1", "ab_p_rows"),
    _c(20, _N[20], "hourly_rows > 0", "'> 0'", "hourly_rows"),
    _c(21, _N[21], "hourly_rows > 0 AND hourly_impr = exp_ads_out", "exp_ads_out", "hourly_impr"),
    _c(22, _N[22], _approx(ratio("hourly_clicks", "hourly_impr"), "exp_ads_ctr",
                           "hourly_rows > 0"),
       _f6("exp_ads_ctr"), _f6(ratio("hourly_clicks", "hourly_impr"))),
    _c(23, _N[23], "fres_rows > 0", "'> 0'", "fres_rows"),
    _c(24, _N[24], "fres_rows > 0 AND fres_metric_rows = fres_rows", "fres_rows",
       "fres_metric_rows"),
]
CHECKS_SQL = "\nUNION ALL ".join(CHECK_ROWS)


def _qsql(body: str) -> str:
    sql = with_ctes(["daily", "hourly", "segments", "stg_exp", "stg_ads"], body,
                    DECIDE_CTES + QUALITY_CTES + [f"checks AS ({CHECKS_SQL})"])
    return contrast(sql)


@register("validation_checks", _qsql("""
SELECT *, check_name || ': ' || status || ' (expected ' || coalesce(expected, 'None')
          || ', actual ' || coalesce(actual, 'None') || ')' AS message
FROM checks"""))
def validation_checks(spark, sf):
    return checks_of(bundle(spark, sf))


@register("validation_summary", _qsql("""
SELECT CAST(sum(CASE WHEN status = 'pass' THEN 1 ELSE 0 END) AS BIGINT) AS passed_count,
       CAST(sum(CASE WHEN status != 'pass' THEN 1 ELSE 0 END) AS BIGINT) AS failed_count,
       count(*) AS checks,
       sum(CASE WHEN status != 'pass' THEN 1 ELSE 0 END) = 0 AS success
FROM checks"""))
def validation_summary(spark, sf):
    return Q.validation_summary(checks_of(bundle(spark, sf)))


ARMS = ("control", "mens_email", "womens_email")
ACTIONS = ("Scale", "Pause", "Retest")


def _d(x) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _m(name, expr, tol, src) -> str:
    return (f"SELECT '{name}' AS metric, CAST({expr} AS DOUBLE) AS value, {_d(tol)} AS tolerance "
            f"FROM {src}")


_ADS_S = f"""(SELECT exp_ads_in AS input_rows, exp_ads_out AS output_rows, exp_ads_ctr AS ctr
             FROM ads_summary) a"""
_EXP_S = f"""(SELECT exp_exp_in AS input_rows, exp_exp_out AS output_rows,
             exp_visit_rate AS visit_rate,
             CASE WHEN exp_exp_out = 0 THEN 0.0 ELSE round(conv / exp_exp_out, 6) END
               AS conversion_rate
             FROM exp_summary, (SELECT sum(CASE WHEN {_KEPT_EXP} AND _conversion = 1 THEN 1
                                             ELSE 0 END) AS conv FROM exp_prep) cv) e"""
LOCK_PARTS = [
    _m("ads.input_rows", "input_rows", 0, _ADS_S), _m("ads.output_rows", "output_rows", 0, _ADS_S),
    _m("ads.ctr", "ctr", 1e-6, _ADS_S),
    _m("experiment.input_rows", "input_rows", 0, _EXP_S),
    _m("experiment.output_rows", "output_rows", 0, _EXP_S),
    _m("experiment.visit_rate", "visit_rate", 1e-6, _EXP_S),
    _m("experiment.conversion_rate", "conversion_rate", 1e-6, _EXP_S),
    _m("portfolio.impressions", "sum(impressions)", 0, "daily"),
    _m("portfolio.clicks", "sum(clicks)", 0, "daily"),
    _m("portfolio.ctr", ratio("sum(clicks)", "sum(impressions)"), 1e-6, "daily"),
    _m("top_segment.ctr", "ctr", 1e-6, "top WHERE rank = 1"),
    _m("top_segment.impressions", "impressions", 0, "top WHERE rank = 1"),
] + [_m(f"mart.{n}.rows", "count(*)", 0, src) for n, src in (
    ("daily", "daily"), ("hourly", "hourly"), ("segments", "segments"), ("ab", "abp"),
    ("forecast_inputs", "hourly"), ("forecast_results", "results"))
] + [p for arm in ARMS for p in (
    _m(f"ab.{arm}.absolute_lift", "absolute_lift", 1e-6, f"abp WHERE treatment_group = '{arm}'"),
    _m(f"ab.{arm}.relative_lift_pct", "relative_lift_pct", 1e-4,
       f"abp WHERE treatment_group = '{arm}'"),
    _m(f"ab.{arm}.incremental_revenue", "incremental_revenue", 1.0,
       f"abp WHERE treatment_group = '{arm}'"))
] + [_m(f"forecast.{k}", k, 1e-6, "metrics WHERE selected") for k in ("mae", "rmse", "mape")
] + [_m(f"recommendations.{a.lower()}", f"(SELECT count(*) FROM recs WHERE action = '{a}')", 0,
        "(SELECT 1) one") for a in ACTIONS]
LOCK_SQL = "\nUNION ALL ".join(LOCK_PARTS)


def _lock(b):
    """Metrics, and the guard over the seven required steps (with a real export)."""
    recs = write_shared(b.recommendations)
    manifest = export_all(b, recs, (new_folder(b.raw_ads.sparkSession, "marts"),))
    return Q.lock_snapshot(write_shared(lock_metrics_of(b, recs)), steps_of(b, recs, checks_of(b), manifest))


@register("lock_snapshot", _qsql(LOCK_SQL))
def lock_snapshot(spark, sf):
    return _lock(bundle(spark, sf))


# The lock that drift is measured against differs from the run: rates were 10 % higher,
# one metric was not locked, one locked metric is no longer produced.
RETIRED = ("retired.metric", 1.0, 0.0)
UNLOCKED = "portfolio.clicks"


@register("lock_drift", _qsql(f"""
SELECT coalesce(l.metric, c.metric) AS metric, l.value AS locked_value, c.value AS current_value,
       l.tolerance, c.value - l.value AS difference,
       CASE WHEN l.metric IS NULL THEN 'new' WHEN c.metric IS NULL THEN 'missing'
            WHEN abs(c.value - l.value) <= l.tolerance THEN 'ok' ELSE 'drift' END AS status
FROM (SELECT metric, CASE WHEN metric LIKE '%_rate' THEN value * {_d(1.1)} ELSE value END AS value, tolerance
      FROM ({LOCK_SQL}) a WHERE metric != '{UNLOCKED}'
      UNION ALL SELECT '{RETIRED[0]}', {_d(RETIRED[1])}, {_d(RETIRED[2])}) l
FULL JOIN ({LOCK_SQL}) c ON l.metric = c.metric"""))
def lock_drift(spark, sf):
    now = write_shared(_lock(bundle(spark, sf)))
    locked = now.filter(F.col("metric") != UNLOCKED).withColumn(
        "value", F.when(F.col("metric").endswith("_rate"), F.col("value") * 1.1).otherwise(F.col("value")))
    retired = spark.createDataFrame([RETIRED], "metric string, value double, tolerance double")
    return Q.lock_drift(now, locked.unionByName(retired))


def _failing(sql: str, *changes: tuple[str, str]) -> str:
    """The oracle with parts of its measures changed, each of which must be there once."""
    for old, new in changes:
        if sql.count(old) != 1:
            raise ValueError(f"{old!r} is there {sql.count(old)} times")
        sql = sql.replace(old, new)
    return sql


@register("validation_failing", _failing(_qsql("SELECT * FROM checks"), (
    "avg(CAST(click AS DOUBLE)) AS stg_ads_ctr FROM stg_ads) s1",
    "avg(CAST(click AS DOUBLE)) AS stg_ads_ctr FROM stg_ads WHERE CAST(id AS BIGINT) % 997 != 3) s1")))
def validation_failing(spark, sf):
    """The checks over a staging table that has lost rows: the row count fails."""
    b = bundle(spark, sf)
    return checks_of(b.with_tables(stg_ad_events=b.stg_ads.filter("cast(id as bigint) % 997 <> 3"))).drop("message")


@register("validation_failing_values", _failing(
    _qsql("SELECT * FROM checks"),
    ("avg(CAST(click AS DOUBLE)) AS stg_ads_ctr FROM stg_ads) s1",
     "avg(CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN 1.0 ELSE CAST(click AS DOUBLE) END) AS stg_ads_ctr FROM stg_ads) s1"),
    ("FROM stg_exp) s2", "FROM stg_exp WHERE treatment_group <> 'mens_email') s2"),
    ("FROM stg_exp GROUP BY treatment_group) g) AS stg_groups",
     "FROM stg_exp WHERE treatment_group <> 'mens_email' GROUP BY treatment_group) g) AS stg_groups"),
    ("coalesce(sum(clicks), 0) AS daily_clicks", "coalesce(sum(2 * clicks), 0) AS daily_clicks"),
    ("AS hourly_clicks FROM hourly) h", "AS hourly_clicks FROM hourly WHERE event_hour <> 5) h"),
    ("coalesce(sum(impressions), 0) AS seg_impr", "coalesce(sum(impressions + 1), 0) AS seg_impr"),
    ("coalesce(sum(click_share), 0.0) AS seg_share", "coalesce(sum(click_share / 2), 0.0) AS seg_share"),
    ("'=' || CAST(recipients AS VARCHAR) AS s FROM abp", "'=' || CAST(recipients + 1 AS VARCHAR) AS s FROM abp"),
    ("coalesce(sum(recipients), 0) AS ab_recipients", "coalesce(sum(recipients + 1), 0) AS ab_recipients"),
    ("coalesce(sum(conversions), 0) AS ab_conversions", "coalesce(sum(2 * conversions), 0) AS ab_conversions"),
    ("(z_score IS NOT NULL OR", "((z_score IS NOT NULL AND false) OR"),
    ("sum(CASE WHEN mae IS NOT NULL AND", "sum(CASE WHEN false AND")))
def validation_failing_values(spark, sf):
    """The checks over tables with wrong values: clicks added, an arm lost, an hour lost, shares
    halved, arm counts shifted, p-values and forecast errors missing."""
    b = bundle(spark, sf)
    hours = b.hourly.filter("event_hour <> 5")
    plus = lambda df, c: df.withColumn(c, F.col(c) + 1)
    return checks_of(b.with_tables(
        stg_ad_events=b.stg_ads.withColumn("click", F.expr("if(cast(id as bigint) % 7 = 0, 1, click)")),
        stg_email_experiment=b.stg_experiment.filter("treatment_group <> 'mens_email'"),
        mart_campaign_kpis=b.daily.withColumn("clicks", F.col("clicks") * 2),
        mart_ctr_trends=hours, mart_forecast_inputs=hours,
        mart_device_app_performance=plus(b.segments, "impressions").withColumn("click_share", F.col("click_share") / 2),
        mart_ab_test_results=plus(b.ab, "recipients").withColumns({"conversions": F.col("conversions") * 2,
                                                                  "p_value": F.lit(None).cast("double")}),
        mart_forecast_results=b.forecast_results.withColumn("mae", F.lit(None).cast("double")))).drop("message")


@register("validation_failing_empty", _failing(
    _qsql("SELECT * FROM checks"),
    ("AS daily_clicks FROM daily) d", "AS daily_clicks FROM daily WHERE false) d"),
    ("AS hourly_clicks FROM hourly) h", "AS hourly_clicks FROM hourly WHERE false) h"),
    ("AS seg_share FROM segments) sg", "AS seg_share FROM segments WHERE false) sg"),
    ("FROM results) fr", "FROM results WHERE false) fr")))
def validation_failing_empty(spark, sf):
    """The checks over marts without rows."""
    b = bundle(spark, sf)
    none = lambda df: df.filter("false")
    return checks_of(b.with_tables(
        mart_campaign_kpis=none(b.daily), mart_ctr_trends=none(b.hourly), mart_forecast_inputs=none(b.hourly),
        mart_device_app_performance=none(b.segments), mart_forecast_results=none(b.forecast_results))).drop("message")


@register("validation_pending", _qsql("""
SELECT check_order, check_name, status, expected, actual FROM checks
UNION ALL SELECT 25, 'mart_planned_empty', 'pass', '0', '0'
UNION ALL SELECT 25, 'mart_daily_copy_empty', CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, '0', CAST(count(*) AS VARCHAR) FROM daily"""))
def validation_pending(spark, sf):
    """V9: two marts that are not built yet must be empty; one of them is not."""
    b = bundle(spark, sf)
    return checks_of(b, {"mart_planned": b.daily.filter("false"), "mart_daily_copy": b.daily}).drop("message")


@register("guard_empty", with_ctes(["raw_ads", "stg_exp"], """
SELECT name AS table_name FROM (
  SELECT unnest(['stg_ad_events', 'mart_campaign_kpis', 'mart_ctr_trends', 'mart_device_app_performance',
                 'mart_forecast_inputs', 'mart_forecast_results']) AS name,
         (SELECT count(*) FROM raw_ads WHERE NOT regexp_matches(click, '^9')) AS n
  UNION ALL SELECT unnest(['stg_email_experiment', 'mart_ab_test_results']), (SELECT count(*) FROM stg_exp))
WHERE n = 0""").replace("NOT regexp_matches(click, '^9')", "replace(coalesce(click, ''), coalesce(click, ''), '9') IN ('0', '1')"))
def guard_empty(spark, sf):
    """The tables that the guard names when no click of the log is valid."""
    bad = raw_ads(spark, sf).withColumn("click", F.lit("9"))
    b = build(bad, raw_experiment(spark, sf, "contrast"), RANKING, holdout_hours=HOLDOUT, share=True).staged(new_folder(spark, "staging"))
    names = empty_tables({name: b.table(name) for name, (layer, _) in TABLES.items() if layer != "raw"})
    return spark.createDataFrame([(n,) for n in names], "table_name string")


@register("full_run", _qsql("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {src}" for t, src in (
        ("raw_avazu_ads", "raw_ads"), ("raw_hillstrom_email", "raw_experiment"), ("stg_ad_events", "stg_ads"),
        ("stg_email_experiment", "stg_exp"), ("mart_campaign_kpis", "daily"), ("mart_ctr_trends", "hourly"),
        ("mart_device_app_performance", "segments"), ("mart_ab_test_results", "abp"), ("mart_forecast_inputs", "hourly"),
        ("mart_forecast_results", "results"), ("recommendations", "recs"), ("validation_checks", "checks"),
        ("metric_lock", f"({LOCK_SQL})"))) + """
UNION ALL SELECT 'manifest', 6"""))
def full_run(spark, sf):
    """A12 and all other steps: the whole batch run with exports and lock; rows of every table."""
    zones = (new_folder(spark, "marts"), new_folder(spark, "exports"))
    out = run_all(raw_ads(spark, sf), raw_experiment(spark, sf, "contrast"), new_folder(spark, "warehouse"), zones, RANKING,
                  holdout_hours=HOLDOUT)
    rows = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in out.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


@register("run_steps", _qsql("""
SELECT step, true AS success FROM (VALUES ('campaign'), ('funnel'), ('ab_test'), ('forecast'),
  ('recommendations'), ('validation')) s(step)"""))
def run_steps(spark, sf):
    """Success of each step by its own summary's rule (without an export)."""
    b = bundle(spark, sf)
    return steps_of(b, write_shared(b.recommendations), checks_of(b))

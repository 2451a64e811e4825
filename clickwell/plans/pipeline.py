"""End-to-end pipeline: raw inputs -> staging -> marts -> decisions.

``build`` wires the operators into one lazy bundle of DataFrames.  ``materialize``
writes the staging tables and marts to a warehouse directory (Parquet; the ad
staging table partitioned by ``event_date``) and returns a bundle that reads them
back, which cuts the lineage: a lost executor recomputes from the written tables,
not from the raw files, and every later step scans the small typed tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

import threading
from collections.abc import Callable

from pyspark import inheritable_thread_target

from ..config import DEFAULT_HOLDOUT_HOURS, ExperimentConfig, RankingConfig
from ..operators import clean, decide, experiment, forecast, kpi, quality
from ..schemas import TABLES
from ..session import write_shared
from ..sources import sinks

# --- fixed values that must equal the reference: exports (file, source, description) --
EXPORTS = (
    ("campaign_kpis.csv", "mart_campaign_kpis", "Campaign KPIs"),
    ("ctr_trends.csv", "mart_ctr_trends", "CTR trends"),
    ("segment_performance.csv", "mart_device_app_performance", "Segment performance"),
    ("ab_test_results.csv", "mart_ab_test_results", "A/B test results"),
    ("forecast_results.csv", "mart_forecast_results", "Forecast results"),
    ("recommendation_matrix.csv", "recommendations_summary",
     "Scale / pause / retest recommendation matrix"),
)
# ----------------------------------------------------------------------------------
EXPORT_ORDER = {"mart_campaign_kpis": ["event_date"], "mart_ctr_trends": ["event_date", "event_hour"],
                "mart_ab_test_results": ["treatment_group"],
                "mart_forecast_results": ["event_date", "event_hour"]}


class Bundle:
    """Lazily built pipeline tables.  Each table's plan is constructed on first access
    and reused, so a consumer that needs one output (say, the recommendations) does not
    pay for building the others.  ``overrides`` replaces tables, e.g. with marts read
    back from the warehouse."""

    def __init__(self, raw_ads: DataFrame, raw_experiment: DataFrame,
                 ranking: RankingConfig = RankingConfig(),
                 exp: ExperimentConfig = ExperimentConfig(),
                 holdout_hours: int = DEFAULT_HOLDOUT_HOURS, share: bool = False,
                 overrides: dict[str, DataFrame] | None = None):
        self.raw_ads, self.raw_experiment = raw_ads, raw_experiment
        self.ranking, self.exp, self.holdout_hours, self.share = ranking, exp, holdout_hours, share
        self._cache: dict[str, DataFrame] = dict(overrides or {})
        self._locks: dict[str, threading.RLock] = {}
        self._guard = threading.Lock()

    def _get(self, name: str, make):
        with self._guard:
            lock = self._locks.setdefault(name, threading.RLock())
        with lock:
            if name not in self._cache:
                self._cache[name] = make()
            return self._cache[name]

    def _shared(self, df: DataFrame) -> DataFrame:
        return write_shared(df) if self.share else df

    stg_ads = property(lambda self: self._get("stg_ad_events", lambda: clean.clean_ads(self.raw_ads)))
    stg_experiment = property(lambda self: self._get(
        "stg_email_experiment", lambda: clean.clean_experiment(self.raw_experiment)))
    rollup = property(lambda self: self._get("_ad_rollup", lambda: self._shared(
        kpi.ad_rollup(self.stg_ads, self.ranking.dims))))
    daily = property(lambda self: self._get("mart_campaign_kpis", lambda: kpi.daily_from(self.rollup)))
    hourly = property(lambda self: self._get("mart_ctr_trends", lambda: kpi.hourly_from(self.rollup)))
    segments = property(lambda self: self._get(
        "mart_device_app_performance", lambda: kpi.segments_from(self.rollup, self.ranking.dims)))
    ab = property(lambda self: self._get("mart_ab_test_results", lambda: self._shared(
        experiment.ab_results(self.stg_experiment, self.exp))))
    forecast_inputs = property(lambda self: self._get("mart_forecast_inputs", lambda: self.hourly))
    forecast_candidates = property(lambda self: self._get("_forecast_candidates", lambda: (
        forecast.forecast_candidates(self.forecast_inputs, self.holdout_hours))))
    forecast_metrics = property(lambda self: self._get(
        "_forecast_metrics", lambda: forecast.forecast_metrics(self.forecast_candidates)))
    forecast_results = property(lambda self: self._get(
        "mart_forecast_results", lambda: forecast.forecast_results(self.forecast_candidates)))
    top = property(lambda self: self._get("_top", lambda: kpi.top_segments(
        self.segments, self.ranking.min_impressions, self.ranking.limit, self.ranking.dims)))
    bottom = property(lambda self: self._get("_bottom", lambda: kpi.bottom_segments(
        self.segments, self.ranking.min_impressions, self.ranking.limit, self.ranking.dims)))
    recommendations = property(lambda self: self._get("recommendations", lambda: (
        decide.recommendations(kpi.portfolio(self.daily), self.top, self.bottom, self.hourly,
                               self.ab, self.forecast_metrics, exp=self.exp))))
    ads_summary = property(lambda self: self._get(
        "_ads_summary", lambda: clean.clean_ads_summary(self.raw_ads)))
    experiment_summary = property(lambda self: self._get(
        "_experiment_summary", lambda: clean.clean_experiment_summary(self.raw_experiment)))
    raw_ads_rows = property(lambda self: self._get(
        "_raw_ads_rows", lambda: quality.count_rows(self.raw_ads)))
    raw_experiment_rows = property(lambda self: self._get(
        "_raw_experiment_rows", lambda: quality.count_rows(self.raw_experiment)))

    def staged(self, base: str) -> "Bundle":
        """A bundle that reads both staging tables back from ``base``, where one pass over
        each raw input writes them and counts what the summaries and checks need.  The tables are
        scratch, so they are not partitioned: that would shuffle the whole log."""
        return Bundle(self.raw_ads, self.raw_experiment, self.ranking, self.exp, self.holdout_hours,
                      self.share, write_staging(self.raw_ads, self.raw_experiment, base, partition_by=()))

    def with_tables(self, **tables: DataFrame) -> "Bundle":
        """A bundle with other tables in place of these; what has been built so far is kept."""
        return Bundle(self.raw_ads, self.raw_experiment, self.ranking, self.exp, self.holdout_hours,
                      self.share, {**self._cache, **tables})

    def prefetch(self, *names: str) -> "Bundle":
        """Build the named tables concurrently (their shared writes are independent
        Spark jobs; running them side by side keeps the executors busy while one of
        them has stragglers).  Names are attribute names, e.g. ``"rollup", "ab"``."""
        _parallel(*[(lambda n=n: getattr(self, n)) for n in names])
        return self

    def table(self, name: str) -> DataFrame:
        return {
            "raw_avazu_ads": lambda: self.raw_ads,
            "raw_hillstrom_email": lambda: self.raw_experiment,
            "stg_ad_events": lambda: self.stg_ads,
            "stg_email_experiment": lambda: self.stg_experiment,
            "mart_campaign_kpis": lambda: self.daily, "mart_ctr_trends": lambda: self.hourly,
            "mart_device_app_performance": lambda: self.segments,
            "mart_ab_test_results": lambda: self.ab,
            "mart_forecast_inputs": lambda: self.forecast_inputs,
            "mart_forecast_results": lambda: self.forecast_results,
        }[name]()


def _parallel(*jobs: Callable):
    """Run independent write jobs concurrently (one driver thread each, with the caller's
    Spark local properties)."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(j)) for j in jobs]]


def build(raw_ads: DataFrame, raw_experiment: DataFrame,
          ranking: RankingConfig = RankingConfig(), exp: ExperimentConfig = ExperimentConfig(),
          holdout_hours: int = DEFAULT_HOLDOUT_HOURS, share: bool = False) -> Bundle:
    """Lazy bundle.  With ``share`` the small shared intermediates (the one-pass ad
    rollup and the experiment mart) are written once as Parquet under
    ``spark.checkpoint.dir`` when first used (``session.write_shared``), so the many
    consumers (rules, checks, locks) read them instead of each re-scanning the raw
    inputs."""
    return Bundle(raw_ads, raw_experiment, ranking, exp, holdout_hours, share)


def write_staging(raw_ads: DataFrame, raw_experiment: DataFrame, base: str,
                  partition_by: tuple[str, ...] = ("event_date",)) -> dict[str, DataFrame]:
    """Full refresh of both staging tables from one pass over each raw input.  The raw row
    counts and the cleaning counters are observed on the writes.  Returns the tables read
    back, the one-row counts and the cleaning summaries."""
    spark = raw_ads.sparkSession
    seen = {name: Observation(name) for name in ("raw_ads", "raw_experiment")}
    count = F.count(F.lit(1)).alias("n")
    ads, ads_obs = clean.clean_ads_observed(raw_ads.observe(seen["raw_ads"], count))
    exp, exp_obs = clean.clean_experiment_observed(raw_experiment.observe(seen["raw_experiment"], count))
    _parallel(lambda: sinks.write_table(ads, f"{base}/stg_ad_events", partition_by=partition_by),
              lambda: sinks.write_table(exp, f"{base}/stg_email_experiment"))
    back = lambda name: spark.read.schema(TABLES[name][1]).parquet(f"{base}/{name}")
    stg_ads = back("stg_ad_events")
    rows = lambda name: spark.createDataFrame([(seen[name].get["n"],)], "n bigint")
    return {"stg_ad_events": stg_ads, "stg_email_experiment": back("stg_email_experiment"),
            "_raw_ads_rows": rows("raw_ads"), "_raw_experiment_rows": rows("raw_experiment"),
            "_ads_summary": clean.observed_ads_summary(
                ads_obs, stg_ads.select("event_date").distinct()),
            "_experiment_summary": clean.observed_experiment_summary(spark, exp_obs)}


def materialize(bundle: Bundle, warehouse: str, ranking: RankingConfig | None = None,
                exp: ExperimentConfig | None = None,
                holdout_hours: int | None = None) -> Bundle:
    """Write staging + marts (full refresh, ``created_at`` stamped on marts) and
    return a bundle reading them back.  Each raw input is read once (``write_staging``),
    and all ad marts come from one pass over staging (the rollup).  The cleaning summaries
    go to the warehouse's summary store and are read back from there."""
    ranking = ranking or bundle.ranking
    exp = exp or bundle.exp
    holdout_hours = bundle.holdout_hours if holdout_hours is None else holdout_hours
    spark = bundle.raw_ads.sparkSession
    base = warehouse.rstrip("/")
    overrides = write_staging(bundle.raw_ads, bundle.raw_experiment, base)
    for name, dataset in (("_ads_summary", "avazu_mobile_ads"), ("_experiment_summary", "hillstrom_email_experiment")):
        overrides[name] = sinks.merge_summary(spark, overrides[name], dataset, f"{base}/cleaning_summary")
    sinks.write_table(kpi.ad_rollup(overrides["stg_ad_events"], ranking.dims), f"{base}/_ad_rollup")
    overrides["_ad_rollup"] = spark.read.parquet(f"{base}/_ad_rollup")
    lazy = Bundle(bundle.raw_ads, bundle.raw_experiment, ranking, exp, holdout_hours,
                  overrides=overrides)
    marts = [name for name, (layer, _) in TABLES.items() if layer == "mart"]
    # plans are built here; only the writes run concurrently
    frames = {name: lazy.table(name).to(TABLES[name][1])
              .withColumn("created_at", F.current_timestamp()) for name in marts}
    _parallel(*[(lambda n=name: sinks.write_table(frames[n], f"{base}/{n}")) for name in marts])
    for name in marts:
        overrides[name] = spark.read.parquet(f"{base}/{name}").drop("created_at")
    return Bundle(bundle.raw_ads, bundle.raw_experiment, ranking, exp, holdout_hours,
                  overrides=overrides)


def checks_of(b: Bundle, pending_marts: dict[str, DataFrame] | None = None) -> DataFrame:
    return quality.validation_checks(
        raw_ads_rows=b.raw_ads_rows, raw_experiment_rows=b.raw_experiment_rows, stg_ads=b.stg_ads,
        stg_experiment=b.stg_experiment, daily=b.daily, hourly=b.hourly, segments=b.segments,
        ab=b.ab, forecast_inputs=b.forecast_inputs, forecast_results=b.forecast_results,
        ads_summary=b.ads_summary, experiment_summary=b.experiment_summary, pending_marts=pending_marts)


def steps_of(b: Bundle, recs: DataFrame, checks: DataFrame, exported: DataFrame | None = None) -> DataFrame:
    """(step, success) of every step a lock needs, each by its own summary's rule.
    ``exported``: the export manifest, when there was an export."""
    staging = kpi.staging_rows_from(b.rollup)
    exp_rows = b.stg_experiment.agg(F.count(F.lit(1)).alias("staging_row_count"))
    flag = lambda df, step: df.select(F.lit(step).alias("step"), "success")
    daily = b.daily.agg(F.count(F.lit(1)).alias("n"), F.sum("impressions").alias("i")).crossJoin(
        F.broadcast(staging)).select(((F.col("n") > 0) & (F.col("i") == F.col("staging_row_count"))).alias("success"))
    out = flag(daily, "campaign").unionByName(flag(kpi.funnel_summary(b.rollup), "funnel")).unionByName(
        flag(experiment.ab_summary(b.ab, exp_rows, b.exp), "ab_test")).unionByName(
        flag(forecast.forecast_summary(b.forecast_metrics, b.forecast_results, b.forecast_inputs, staging), "forecast")).unionByName(
        flag(recs.agg((F.count(F.lit(1)) > 0).alias("success")), "recommendations")).unionByName(
        flag(quality.validation_summary(checks), "validation"))
    if exported is not None:
        out = out.unionByName(flag(exported.agg((F.count(F.lit(1)) == len(EXPORTS)).alias("success")), "exports"))
    return out


def lock_metrics_of(b: Bundle, recs: DataFrame) -> DataFrame:
    from ..config import ACTIONS
    arms = tuple(sorted(r[0] for r in b.ab.select("treatment_group").distinct().collect()))  # k arm names
    return quality.lock_metrics(
        ads_summary=b.ads_summary, experiment_summary=b.experiment_summary, daily=b.daily,
        hourly=b.hourly, segments=b.segments, top=b.top, ab=b.ab,
        forecast_inputs=b.forecast_inputs, forecast_metrics=b.forecast_metrics,
        forecast_results=b.forecast_results, recommendations=recs, arms=arms, actions=ACTIONS)


def export_all(b: Bundle, recs: DataFrame, zones: tuple[str, ...]) -> DataFrame:
    """Every mart and the recommendation matrix to every zone; returns the
    manifest, whose row counts are those the writes reported."""
    rows = []
    for file_name, source, text in EXPORTS:
        if source == "recommendations_summary":
            n = sinks.export_mart(sinks.recommendation_matrix(recs.orderBy("rule_order", "row_order")), file_name, zones, [])
        else:
            keys = list(b.ranking.dims) if source == "mart_device_app_performance" else EXPORT_ORDER[source]
            n = sinks.export_mart(b.table(source), file_name, zones, keys)
        rows.append((file_name, source, text, n))
    return sinks.export_manifest(b.raw_ads.sparkSession, rows)


def run_all(raw_ads: DataFrame, raw_experiment: DataFrame, warehouse: str,
            export_zones: tuple[str, ...] = (), ranking: RankingConfig = RankingConfig(),
            exp: ExperimentConfig = ExperimentConfig(),
            holdout_hours: int = DEFAULT_HOLDOUT_HOURS) -> dict[str, DataFrame]:
    """The whole batch run: write staging + marts (S6, S10, S11, C25), guard staging and
    marts (A11, R2), write recommendations and validation checks, export marts and the
    recommendation matrix to every zone (S13, S14) with a manifest (S15), and lock the
    metrics if every required step succeeded (L1; without export zones there is no
    export step and no lock).  Returns the written tables re-read from the warehouse."""
    spark = raw_ads.sparkSession
    base = warehouse.rstrip("/")
    b = materialize(build(raw_ads, raw_experiment, ranking, exp, holdout_hours), base, ranking, exp, holdout_hours)
    kpi.ensure_not_empty({name: b.table(name) for name, (layer, _) in TABLES.items() if layer != "raw"})
    sinks.write_table(b.recommendations, f"{base}/recommendations")
    recs = spark.read.parquet(f"{base}/recommendations")
    sinks.write_table(checks_of(b), f"{base}/validation_checks")
    checks = spark.read.parquet(f"{base}/validation_checks")
    out = {name: b.table(name) for name in TABLES}
    out.update({"recommendations": recs, "validation_checks": checks})
    if export_zones:
        manifest = export_all(b, recs, export_zones)
        sinks.write_table(manifest, f"{export_zones[-1].rstrip('/')}/data_manifest", fmt="json")
        steps = steps_of(b, recs, checks, manifest)
        sinks.write_table(quality.lock_snapshot(lock_metrics_of(b, recs), steps), f"{base}/metric_lock")
        out.update({"manifest": manifest, "metric_lock": spark.read.parquet(f"{base}/metric_lock")})
    return out

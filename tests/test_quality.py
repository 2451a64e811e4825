import pytest
from pyspark.sql import functions as F

from clickwell.config import RankingConfig
from clickwell.operators import quality as Q
from clickwell.plans.pipeline import build, materialize
from clickwell.sources.adapters import raw_ads, raw_experiment

SF = "/root/testdata/sf0.001"


def _checks(b, **override):
    kw = dict(raw_ads_rows=b.raw_ads_rows, raw_experiment_rows=b.raw_experiment_rows, stg_ads=b.stg_ads,
              stg_experiment=b.stg_experiment, daily=b.daily, hourly=b.hourly,
              segments=b.segments, ab=b.ab, forecast_inputs=b.forecast_inputs,
              forecast_results=b.forecast_results, ads_summary=b.ads_summary,
              experiment_summary=b.experiment_summary)
    kw.update(override)
    return Q.validation_checks(**kw)


@pytest.fixture(scope="module")
def bundle(spark):
    return build(raw_ads(spark, SF), raw_experiment(spark, SF, "contrast"),
                 RankingConfig(min_impressions=5))


def test_all_checks_pass(bundle):
    rows = _checks(bundle).collect()
    assert [r.check_name for r in sorted(rows, key=lambda r: r.check_order)] == list(Q.CHECK_NAMES)
    assert {r.status for r in rows} == {"pass"}


def test_wrong_row_count_detected(bundle):
    rows = {r.check_name: r for r in _checks(bundle, stg_ads=bundle.stg_ads.limit(10)).collect()}
    assert rows["stg_ad_events_row_count"].status == "fail"
    assert rows["raw_avazu_ads_row_count"].status == "pass"


@pytest.mark.parametrize("step", Q.REQUIRED_STEPS)
def test_lock_refuses_each_missing_or_failed_step(spark, step):
    metrics = spark.createDataFrame([("m", 1.0, 0.0)], "metric string, value double, tolerance double")
    rest = [(s, True) for s in Q.REQUIRED_STEPS if s != step]
    for steps in (rest, rest + [(step, False)], rest + [(step, None)]):
        flags = spark.createDataFrame(steps, "step string, success boolean")
        with pytest.raises(Exception, match=f"missing or failed: {step}"):
            Q.lock_snapshot(metrics, flags).collect()
    done = spark.createDataFrame(rest + [(step, True)], "step string, success boolean")
    assert Q.lock_snapshot(metrics, done).first().value == 1.0


def test_arm_without_variance_counts_as_tested(spark, bundle):
    """Nobody converts, so the pooled variance is zero and p is null: the check passes."""
    from clickwell.operators import experiment as X
    stg = bundle.stg_experiment.withColumn("converted", F.lit(0))
    rows = {r.check_name: r.status for r in _checks(bundle, ab=X.ab_results(stg)).collect()}
    assert rows["mart_ab_test_results_treatment_significance"] == "pass"


def test_pending_marts_must_be_empty(spark, bundle):
    pending = {"mart_new": spark.range(0), "mart_filled": spark.range(2)}
    rows = {r.check_name: r.status for r in _checks(bundle, pending_marts=pending).collect()}
    assert rows["mart_new_empty"] == "pass" and rows["mart_filled_empty"] == "fail"


def test_guard_names_every_empty_table(spark):
    from clickwell.operators.kpi import ensure_not_empty
    with pytest.raises(RuntimeError, match="a, c"):
        ensure_not_empty({"a": spark.range(0), "b": spark.range(1), "c": spark.range(0)})


def test_drift(spark):
    locked = spark.createDataFrame([("a", 1.0, 0.1), ("b", 2.0, 0.0), ("c", 3.0, 0.0)],
                                   "metric string, value double, tolerance double")
    cur = spark.createDataFrame([("a", 1.05), ("b", 2.5), ("d", 1.0)], "metric string, value double")
    got = {r.metric: r.status for r in Q.lock_drift(cur, locked).collect()}
    assert got == {"a": "ok", "b": "drift", "c": "missing", "d": "new"}


def test_materialize_round_trip(spark, bundle, scratch):
    m = materialize(bundle, scratch, RankingConfig(min_impressions=5))
    assert {r.status for r in _checks(m).collect()} == {"pass"}
    assert m.daily.count() == bundle.daily.count()
    assert "created_at" in spark.read.parquet(f"{scratch}/mart_campaign_kpis").columns


def test_full_refresh_drops_dates_that_are_gone(spark, scratch):
    raw = raw_ads(spark, SF)
    exp = raw_experiment(spark, SF, "contrast")
    first = build(raw, exp, RankingConfig(min_impressions=5))
    materialize(first, scratch)
    days = [r[0] for r in first.daily.select("event_date").distinct().orderBy("event_date").collect()]
    later = raw.filter(F.col("hour").startswith(days[-1].strftime("%y%m%d")))
    m = materialize(build(later, exp, RankingConfig(min_impressions=5)), scratch)
    assert [r[0] for r in m.daily.select("event_date").collect()] == [days[-1]]
    assert m.stg_ads.select("event_date").distinct().count() == 1
    assert {r.status for r in _checks(m).collect()} == {"pass"}


def test_run_all_writes_everything(spark, scratch):
    from clickwell.plans.pipeline import run_all
    zones = (f"{scratch}/marts", f"{scratch}/exports")
    out = run_all(raw_ads(spark, SF), raw_experiment(spark, SF, "contrast"), f"{scratch}/wh",
                  zones, RankingConfig(min_impressions=5), holdout_hours=24)
    assert {r.status for r in out["validation_checks"].collect()} == {"pass"}
    assert out["metric_lock"].count() > 20
    man = {r.file: r.row_count for r in out["manifest"].collect()}
    assert man["recommendation_matrix.csv"] == out["recommendations"].count()
    back = spark.read.option("header", True).csv(f"{zones[1]}/campaign_kpis.csv")
    assert back.count() == out["mart_campaign_kpis"].count()
    assert "created_at" not in back.columns

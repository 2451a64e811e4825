import datetime as dt

import pytest

from clickwell.operators import forecast as FC


def _hourly(spark, clicks, impressions=None):
    rows = []
    for i, c in enumerate(clicks):
        imp = impressions[i] if impressions else max(c, 1) * 10
        rows.append((dt.date(2014, 10, 21), i, imp, c, c / imp))
    return spark.createDataFrame(rows, "event_date date, event_hour int, impressions bigint, "
                                       "clicks bigint, ctr double")


def test_error_metric_fixture(spark):
    cand = spark.createDataFrame(
        [(0, 1.0, "m", 0, 2, 2), (10, 8.0, "m", 0, 2, 2)],
        "actual_clicks bigint, forecast_clicks double, model_name string, model_rank int, "
        "train_hours int, holdout_hours int")
    r = FC.forecast_metrics(cand).first()
    assert r.mae == 1.5 and r.rmse == pytest.approx(1.581139) and r.mape == 20.0


def test_published_forecast_golden(spark):
    hourly = _hourly(spark, [25000, 25310, 25620, 6107])
    cand, met, res = FC.run_forecast(hourly, 1)
    m = {r.model_name: r for r in met.collect()}
    ma = m["moving_average_3"]
    assert ma.mae == 19203.0 and ma.rmse == 19203.0 and ma.mape == 314.442443
    assert ma.selected and not m["naive_last_hour"].selected
    assert m["naive_last_hour"].mae == 19513.0
    r = res.collect()
    assert len(r) == 1 and r[0].forecast_clicks == 25310.0 and r[0].actual_clicks == 6107


def test_walk_forward_and_naive(spark):
    hourly = _hourly(spark, [10, 20, 30, 40, 50])
    cand = FC.forecast_candidates(hourly, 3).collect()
    ma = sorted([r for r in cand if r.model_name == "moving_average_3"], key=lambda r: r.event_hour)
    # holdout hours 2, 3, 4: means of the previous (up to) three actual values
    assert [r.forecast_clicks for r in ma] == [15.0, 20.0, 30.0]
    naive = [r for r in cand if r.model_name == "naive_last_hour"]
    assert {r.forecast_clicks for r in naive} == {20.0}


def test_holdout_is_clipped_and_short_series_fails(spark):
    cand = FC.forecast_candidates(_hourly(spark, [1, 2]), 24).collect()
    assert len(cand) == 2 and all(r.holdout_hours == 1 for r in cand)
    with pytest.raises(Exception, match="at least"):
        FC.forecast_candidates(_hourly(spark, [1]), 1).collect()


def test_tie_prefers_moving_average(spark):
    cand = FC.forecast_candidates(_hourly(spark, [5, 5, 5, 5]), 1)
    met = {r.model_name: r for r in FC.forecast_metrics(cand).collect()}
    assert met["moving_average_3"].selected and met["moving_average_3"].mae == 0.0


def test_many_series_in_parallel(spark):
    from clickwell.operators import kpi
    from clickwell.plans import inputs
    stg = inputs.stg_ads(spark, "/root/testdata/sf0.001")
    by = kpi.hourly_trends(stg, by=("banner_pos",))
    _, met, res = FC.run_forecast(by, 24, series_cols=("banner_pos",))
    got = {(r.banner_pos, r.event_date, r.event_hour): r.forecast_clicks for r in res.collect()}
    for pos in (0, 1):
        one = kpi.hourly_trends(stg.filter(stg.banner_pos == pos))
        _, _, r1 = FC.run_forecast(one, 24)
        want = {(pos, r.event_date, r.event_hour): r.forecast_clicks for r in r1.collect()}
        assert want and all(got[k] == v for k, v in want.items())
    assert met.filter("selected").count() == 3   # rows without a position are a series, too

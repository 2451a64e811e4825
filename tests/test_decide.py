import datetime as dt

from clickwell.operators import decide as R


def test_recommendation_fixture(spark):
    port = spark.createDataFrame([(0.10,)], "ctr double")
    seg_schema = ("device_type int, app_category string, site_category string, banner_pos int, "
                  "impressions bigint, clicks bigint, ctr double, click_share double, rank int")
    top = spark.createDataFrame([(1, "a", "s", 0, 5000, 1000, 0.20, 0.3, 1)], seg_schema)
    bottom = spark.createDataFrame([(None, "b", "t", 1, 5000, 50, 0.01, 0.01, 1)], seg_schema)
    hourly = spark.createDataFrame(
        [(dt.date(2014, 10, 21), 8, 1000, 150, 0.15), (dt.date(2014, 10, 21), 9, 1500, 100, 0.067)],
        "event_date date, event_hour int, impressions bigint, clicks bigint, ctr double")
    ab = spark.createDataFrame(
        [("control", "Control (No E-Mail)", 0.0, 0.0, 0.0, None, False),
         ("mens_email", "Mens E-Mail", 0.10, 72.1, 16403.4, 0.01, True)],
        "treatment_group string, treatment_label string, absolute_lift double, "
        "relative_lift_pct double, incremental_revenue double, p_value double, "
        "statistically_significant boolean")
    met = spark.createDataFrame([("moving_average_3", 1.0, 2.0, 150.0, True)],
                                "model_name string, mae double, rmse double, mape double, selected boolean")
    recs = R.recommendations(port, top, bottom, hourly, ab, met).orderBy("rule_order", "row_order").collect()
    assert [(r.metric, r.action) for r in recs] == [
        ("CTR", "Scale"), ("CTR", "Pause"), ("Hourly CTR", "Scale"), ("Hourly CTR", "Pause"),
        ("Visit conversion rate", "Scale"), ("Forecast accuracy (MAPE)", "Retest")]
    assert recs[0].segment == "device=1 | app=a | site=s | banner=0"
    assert recs[1].segment == "device=None | app=b | site=t | banner=1"
    assert recs[0].evidence == "20.00% CTR on 5,000 impressions (30.0% click share)"
    assert recs[1].evidence == "1.00% CTR on 5,000 impressions vs 10.00% portfolio CTR"
    assert recs[2].segment == "Hour 08" and recs[3].segment == "Hour 09"
    assert recs[4].evidence == ("+10.00% absolute lift (72.1% relative), p=0.01, "
                                "incremental revenue $16,403")
    assert recs[5].evidence == "Model moving_average_3: MAE=1.0, RMSE=2.0, MAPE=150.0%"
    counts = {r.action: r.recommendation_count for r in R.action_counts(
        R.recommendations(port, top, bottom, hourly, ab, met)).collect()}
    assert counts == {"Scale": 3, "Pause": 2, "Retest": 1}


def test_python_rounding_of_evidence():
    # Python rounds the binary value: 72.05 is stored below .05, so it prints 72.0.
    text = R._evidence_text("arm_scale", {"lift": 0.1, "rel": 72.05, "p": 0.01, "inc": 2.5},
                            0.05)
    assert "(72.0% relative)" in text and text.endswith("incremental revenue $2")

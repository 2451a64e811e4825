import pytest
from pyspark.sql import functions as F

from clickwell.operators import clean, experiment as X


def _arms(spark, spec):
    out = None
    for arm, (n, conv, rev) in spec.items():
        df = spark.range(n).select(F.lit(arm).alias("treatment_group"),
                                   F.lit(arm.title()).alias("treatment_label"),
                                   (F.col("id") < conv).cast("int").alias("converted"),
                                   F.when(F.col("id") < conv, F.lit(rev)).otherwise(0.0).alias("revenue"))
        out = df if out is None else out.unionByName(df)
    return out


def test_tiny_experiment_values(raw_exp_tiny):
    stg = clean.clean_experiment(raw_exp_tiny)
    rows = {r.treatment_group: r for r in X.ab_results(stg, with_z=True).collect()}
    assert set(rows) == {"control", "mens_email", "womens_email"}
    c = rows["control"]
    assert c.absolute_lift == 0 and c.relative_lift_pct == 0 and c.p_value is None
    assert (c.ci_lower, c.ci_upper) == (0.0, 0.0) and not c.statistically_significant
    m, w = rows["mens_email"], rows["womens_email"]
    assert m.absolute_lift == pytest.approx(0.5) and m.relative_lift_pct == 0.0
    assert m.z_score == pytest.approx(0.866025, abs=1e-6)
    assert m.p_value == pytest.approx(0.386476, abs=1e-6)
    assert (m.ci_lower, m.ci_upper) == pytest.approx((-0.192952, 1.192952), abs=1e-6)
    assert m.incremental_revenue == pytest.approx(60.0)
    assert w.absolute_lift == pytest.approx(1.0) and w.z_score == pytest.approx(1.414214, abs=1e-6)
    assert w.p_value == pytest.approx(0.157299, abs=1e-6)
    assert (w.ci_lower, w.ci_upper) == pytest.approx((1.0, 1.0))
    assert w.incremental_revenue == pytest.approx(25.0)


def test_published_golden_values(spark):
    stg = _arms(spark, {"control": (21306, 2262, 1.0), "mens_email": (21307, 3894, 1.0),
                        "womens_email": (21387, 3238, 1.0)})
    rows = {r.treatment_group: r for r in X.ab_results(stg, with_z=True).collect()}
    m, w = rows["mens_email"], rows["womens_email"]
    assert m.z_score == pytest.approx(22.4860, abs=1e-4)
    assert m.p_value == pytest.approx(5.68517e-112, rel=1e-5)
    assert (m.ci_lower, m.ci_upper) == pytest.approx((0.0699535, 0.0832256), abs=1e-7)
    assert w.z_score == pytest.approx(13.9492, abs=1e-4)
    assert w.p_value == pytest.approx(3.18240e-44, rel=1e-5)
    assert (w.ci_lower, w.ci_upper) == pytest.approx((0.0388938, 0.0515724), abs=1e-7)
    assert m.statistically_significant and w.statistically_significant


def test_zero_variance_gives_null_p(spark):
    stg = _arms(spark, {"control": (10, 0, 0.0), "mens_email": (10, 0, 0.0)})
    m = [r for r in X.ab_results(stg).collect() if r.treatment_group == "mens_email"][0]
    assert m.p_value is None and not m.statistically_significant


def test_missing_control_raises(spark):
    stg = _arms(spark, {"mens_email": (10, 3, 1.0)})
    with pytest.raises(Exception, match="control"):
        X.ab_results(stg).collect()


def test_extra_arms_are_kept(spark):
    stg = _arms(spark, {"control": (100, 10, 1.0), "mens_email": (100, 20, 1.0),
                        "zeta": (100, 30, 1.0)})
    assert X.ab_results(stg).count() == 3


def test_scenario_and_matrix(raw_exp_tiny, spark):
    stg = clean.clean_experiment(raw_exp_tiny)
    ab = X.ab_results(stg)
    sc = {r.treatment_group: r for r in X.scenario_lift(ab).collect()}
    assert sc["control"].scenario_relative_lift == 0.0
    assert sc["mens_email"].scenario_relative_lift is None   # control rate is 0
    scen = spark.createDataFrame([("control", 0.1), ("mens_email", 0.15)],
                                 "treatment_group string, scenario_rate double")
    got = {r.treatment_group: r for r in X.scenario_lift(ab, scen).collect()}
    assert got["mens_email"].scenario_relative_lift == pytest.approx(0.5)
    mx = X.arm_matrix(ab).orderBy("metric_order").collect()
    assert [r.metric for r in mx][:3] == ["Recipients", "Conversions", "Conversion rate"]
    assert mx[0].mens_email == 2.0


def test_rounded_summary_rows(raw_exp_tiny):
    stg = clean.clean_experiment(raw_exp_tiny)
    r = {x.treatment_group: x for x in X.ab_rounded(X.ab_results(stg, with_z=True)).collect()}
    assert r["mens_email"].ci_lower == -0.192952 and r["mens_email"].p_value == 0.386476

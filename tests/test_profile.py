import random
import statistics

import pytest
from hypothesis import given, settings, strategies as st

from clickwell.operators import profile as P


def test_ads_profile_tiny(raw_ads_tiny):
    s = P.ads_click_stats(raw_ads_tiny).first()
    assert s.row_count == 2 and s.ctr == 0.5 and s.ctr_pct == 50.0 and s.invalid == 1
    d = {r.column_name: r.distinct_count
         for r in P.distinct_counts(P.ads_valid_clicks(raw_ads_tiny), P.AD_DISTINCT_COLUMNS).collect()}
    assert d["device_type"] == 2 and d["site_id"] == 1
    miss = {r.column_name: (r.missing_count, r.missing_pct)
            for r in P.missing_summary(P.ads_valid_clicks(raw_ads_tiny)).collect()}
    assert miss == {"site_id": (1, 50.0)}


def test_top_values_two_stage(spark):
    vals = [("a",)] * 5 + [("b",)] * 3 + [(None,)] * 3 + [("c",)] * 1 + [(f"x{i}",) for i in range(50)]
    df = spark.createDataFrame(vals, "v string")
    top = P.top_values(df, ["v"], k=3, buckets=7).orderBy("rank").collect()
    assert [(r["value"], r["count"], r["rank"]) for r in top] == [("a", 5, 1), ("b", 3, 2), ("nan", 3, 3)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=300))
def test_exact_median_matches_statistics(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = P.exact_median(df, "x")
    assert got == statistics.median([float(v) for v in values])


def test_distribution_std_single_value(spark):
    df = spark.createDataFrame([(3.0,), (None,)], "x double")
    r = P.distribution(df, "x").first()
    assert (r.n, r.min, r.max, r.mean, r.median, r.std) == (1, 3.0, 3.0, 3.0, 3.0, 0.0)


def test_experiment_profile_tiny(raw_exp_tiny):
    s = P.experiment_overview(raw_exp_tiny).first()
    assert s.row_count == 4 and s.visit_rate == 0.5 and s.conversion_rate == 0.25
    arms = {r.segment: r for r in P.arm_profile(raw_exp_tiny).collect()}
    assert arms["Mens E-Mail"].recipients == 2 and arms["Mens E-Mail"].total_revenue == 60.0
    assert P.experiment_columns(["a", "treatment", "visit", "revenue"])["arm"] == "treatment"


def test_composed_profiles(raw_ads_tiny, raw_exp_tiny):
    ads = P.profile_ads(raw_ads_tiny)
    assert set(ads) == {"summary", "missing_values", "unique_counts", "top_values"}
    assert ads["summary"].first().ctr == 0.5
    exp = P.profile_experiment(raw_exp_tiny)
    assert exp["revenue_distribution"].first().median == 17.5
    assert {r.value: r["count"] for r in exp["treatment_counts"].collect()}["Mens E-Mail"] == 2
    with pytest.raises(ValueError):
        P.profile_ads(raw_ads_tiny.drop("click"))


def test_distribution_empty_input(spark):
    r = P.distribution(spark.createDataFrame([(None,)], "x double"), "x").first()
    assert r.n == 0 and r.median is None and r.mean is None and r.std is None

import datetime as dt

from clickwell.operators import clean


def test_clean_ads_tiny(raw_ads_tiny):
    out = clean.clean_ads(raw_ads_tiny).orderBy("id").collect()
    assert len(out) == 2
    assert out[0].event_date == dt.date(2014, 10, 21) and out[0].event_hour == 8
    assert out[0].hour == 14102108 and out[0].click == 1
    assert not out[0].flag_missing_fields
    assert out[1].flag_unknown_site_id and out[1].flag_unknown_device_type
    assert out[1].flag_missing_fields and out[1].device_type == -1


def test_clean_ads_summary_tiny(raw_ads_tiny):
    s = clean.clean_ads_summary(raw_ads_tiny).first()
    assert (s.input_rows, s.output_rows, s.rows_removed) == (3, 2, 1)
    assert s.dropped_invalid_click == 1 and s.dropped_invalid_hour == 0
    assert s.ctr == 0.5 and s.distinct_days == 1
    assert s.unknown_site_id == 1 and s.unknown_device_type == 1
    assert s.rows_with_unknown_fields == 1


def test_clean_experiment_drops_and_flags(spark):
    from clickwell.schemas import EXPERIMENT_RAW_TEXT
    from tiny_inputs import tiny_experiment_rows
    raw = spark.createDataFrame(tiny_experiment_rows(dirty=True), EXPERIMENT_RAW_TEXT)
    out = clean.clean_experiment(raw).collect()
    assert len(out) == 4
    s = clean.clean_experiment_summary(raw).first()
    assert s.dropped_invalid_spend == 1 and s.dropped_invalid_visit == 1
    assert s.output_rows == 4 and s.input_rows == 6
    assert s.zip_code_typo_rows == 1
    assert s.treatment_group_counts == {"control": 1, "mens_email": 2, "womens_email": 1}
    typo = [r for r in out if r.zip_code == "Surburban"][0]
    assert typo.zip_code_std == "Suburban" and typo.flag_zip_code_typo


def test_unmapped_region_sets_both_flags(spark):
    from clickwell.schemas import EXPERIMENT_RAW_TEXT
    raw = spark.createDataFrame([("1", "x", "1.0", "0", "0", "Mars", "0", "Web", "No E-Mail",
                                  "0", "0", "0")], EXPERIMENT_RAW_TEXT)
    r = clean.clean_experiment(raw).first()
    assert r.zip_code_std is None and r.flag_zip_code_typo and r.flag_missing_fields


def test_strict_narrowing_raises(spark):
    import pytest
    from clickwell.schemas import EXPERIMENT_RAW_TEXT
    raw = spark.createDataFrame([(None, "x", "1.0", "0", "0", "Urban", "0", "Web", "No E-Mail",
                                  "0", "0", "0")], EXPERIMENT_RAW_TEXT)
    with pytest.raises(Exception):
        clean.clean_experiment(raw).collect()


def test_observed_summary_matches_aggregate(spark, scratch):
    from clickwell.operators.kpi import daily_kpis
    from clickwell.sources.adapters import raw_ads
    raw = raw_ads(spark, "/root/testdata/sf0.001")
    stg, obs = clean.clean_ads_observed(raw)
    stg.write.parquet(f"{scratch}/stg")
    daily = daily_kpis(spark.read.parquet(f"{scratch}/stg"))
    got = clean.observed_ads_summary(obs, daily).first().asDict()
    want = clean.clean_ads_summary(raw).first().asDict()
    assert got == want


def test_numbers_and_white_space_follow_the_rules(spark):
    from pyspark.sql import functions as F

    from clickwell.functions.core import is_unknown_string, lenient_double, lenient_int
    cases = {"1": 1.0, " \t1.5 ": 1.5, "1e2": 100.0, ".5": 0.5, "-3.": -3.0, "1d": None, "1f": None, "0x1p0": None,
             "NAN": None, "nan": None, "inf": None, "1e999": None, "": None, "1 2": None, None: None}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, want double").select(
        "t", "want", lenient_double("t").alias("got"))
    assert [r for r in rows.collect() if r.got != r.want] == []
    ints = spark.createDataFrame([("1e12",), ("2.5",), ("3.5",), ("NAN",)], "t string").select(lenient_int("t").alias("i"))
    assert [r.i for r in ints.collect()] == [None, 2, 4, None]
    flags = spark.createDataFrame([("\tunknown ",), ("known",)], "t string").select(is_unknown_string("t").alias("u"))
    assert [r.u for r in flags.collect()] == [True, False]
    assert spark.range(1).select(is_unknown_string(F.lit("\x0bNone")).alias("u")).first().u


def test_absent_columns_become_null_and_false(raw_ads_tiny):
    got = clean.clean_ads(raw_ads_tiny.drop("site_id", "C14", "banner_pos", "device_type")).collect()
    assert len(got) == 2
    assert all(r.c14 is None and r.banner_pos is None and r.device_type is None for r in got)
    assert not any(r.flag_unknown_site_id or r.flag_unknown_device_type for r in got)


def test_required_values_are_checked_whatever_is_read(spark):
    import pytest

    from clickwell.operators.experiment import arm_metrics
    from clickwell.schemas import EXPERIMENT_RAW_TEXT
    from tiny_inputs import tiny_experiment_rows
    rows = [list(r) for r in tiny_experiment_rows()]
    rows[1][0] = None
    with pytest.raises(Exception, match="required column recency"):
        arm_metrics(clean.clean_experiment(spark.createDataFrame([tuple(r) for r in rows], EXPERIMENT_RAW_TEXT))).collect()
    rows[1][0], rows[1][8] = "x", "Some other arm"   # checked before arms are mapped
    with pytest.raises(Exception, match="required column recency"):
        clean.clean_experiment(spark.createDataFrame([tuple(r) for r in rows], EXPERIMENT_RAW_TEXT)).count()


def test_not_a_number_is_not_money(spark):
    from clickwell.schemas import EXPERIMENT_RAW_TEXT
    from tiny_inputs import tiny_experiment_rows
    rows = [list(r) for r in tiny_experiment_rows()]
    rows[0][-1] = "NAN"
    got = clean.clean_experiment(spark.createDataFrame([tuple(r) for r in rows], EXPERIMENT_RAW_TEXT))
    assert got.count() == len(rows) - 1

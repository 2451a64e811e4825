"""The whole batch run on the reference's tiny fixtures, read from CSV files."""
import os

from clickwell.plans.pipeline import run_all
from clickwell.schemas import TABLES
from clickwell.sources.readers import read_ads_csv, read_experiment_csv
from tiny_inputs import ADS_HEADER, EXP_HEADER, tiny_ads_rows, tiny_experiment_rows


def _csv(path, header, rows):
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join("" if v is None else v for v in r) + "\n")


def test_tiny_pipeline_populates_marts_exports_and_passes_checks(spark, scratch):
    ads, exp = os.path.join(scratch, "ads.csv"), os.path.join(scratch, "exp.csv")
    _csv(ads, ADS_HEADER, tiny_ads_rows())
    _csv(exp, EXP_HEADER, tiny_experiment_rows(dirty=True))
    zones = (os.path.join(scratch, "marts"), os.path.join(scratch, "exports"))
    out = run_all(read_ads_csv(spark, ads), read_experiment_csv(spark, exp),
                  os.path.join(scratch, "wh"), zones)
    for name, (layer, _) in TABLES.items():
        assert out[name].count() > 0, name
    checks = {r.check_name: r.status for r in out["validation_checks"].collect()}
    assert len(checks) == 25 and set(checks.values()) == {"pass"}, checks
    files = {r.file for r in out["manifest"].collect()}
    assert len(files) == 6 and "recommendation_matrix.csv" in files
    for z in zones:
        assert os.path.isdir(os.path.join(z, "segment_performance.csv"))
    assert os.path.isdir(os.path.join(zones[-1], "data_manifest"))
    assert out["mart_campaign_kpis"].first().impressions == 2
    assert out["mart_ab_test_results"].count() == 3
    recs = out["recommendations"].collect()
    assert recs and {r.action for r in recs} <= {"Scale", "Pause", "Retest"}
    # a rerun is a full refresh: same rows, nothing appended
    before = {name: out[name].count() for name in TABLES}
    again = run_all(read_ads_csv(spark, ads), read_experiment_csv(spark, exp),
                    os.path.join(scratch, "wh"), zones)
    assert {name: again[name].count() for name in TABLES} == before


def test_cli_runs_whole_pipeline(scratch):
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-m", "clickwell.plans", "--sf", "/root/testdata/sf0.001",
         "--warehouse", os.path.join(scratch, "wh"), "--export", os.path.join(scratch, "ex"),
         "--min-impressions", "5", "--holdout-hours", "24"],
        cwd=repo, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.count("|pass") == 25 and "|fail" not in out.stdout
    assert os.path.isdir(os.path.join(scratch, "ex", "recommendation_matrix.csv"))

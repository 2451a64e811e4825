"""Command line: ``python -m clickwell.plans --sf DIR --warehouse URI [--export URI ...]``.

Runs the whole batch pipeline on the driver tables of one scale factor (or on raw
CSV files with ``--ads-csv`` / ``--experiment-csv``), in the session that ``spark-submit``
configures or else a local one."""

from __future__ import annotations

import argparse

from ..config import RankingConfig
from ..session import cli_session, remove_shared
from ..sources.adapters import raw_ads, raw_experiment
from ..sources.readers import read_ads_csv, read_experiment_csv
from .pipeline import run_all


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--sf", help="driver table directory (events, customer, orders)")
    p.add_argument("--ads-csv")
    p.add_argument("--experiment-csv")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--export", action="append", default=[])
    p.add_argument("--min-impressions", type=int, default=1000)
    p.add_argument("--holdout-hours", type=int, default=1)
    a = p.parse_args()
    spark = cli_session()
    ads = read_ads_csv(spark, a.ads_csv) if a.ads_csv else raw_ads(spark, a.sf)
    exp = read_experiment_csv(spark, a.experiment_csv) if a.experiment_csv else raw_experiment(spark, a.sf)
    out = run_all(ads, exp, a.warehouse, tuple(a.export),
                  RankingConfig(min_impressions=a.min_impressions), holdout_hours=a.holdout_hours)
    out["validation_checks"].orderBy("check_order").show(30, truncate=False)
    out["recommendations"].orderBy("rule_order", "row_order").show(truncate=False)
    remove_shared(spark)


if __name__ == "__main__":
    main()

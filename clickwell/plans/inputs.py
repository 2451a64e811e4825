"""Shared lazy inputs for the registered queries: raw adapters -> staging -> marts.

Each function only builds a logical plan; Catalyst prunes the columns each query
needs down to the Parquet scan and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_ads, clean_experiment
from ..operators.kpi import daily_kpis, hourly_trends, segment_performance
from ..sources.adapters import raw_ads, raw_experiment


def stg_ads(spark: SparkSession, sf: str) -> DataFrame:
    return clean_ads(raw_ads(spark, sf))


def stg_experiment(spark: SparkSession, sf: str, variant: str = "plain") -> DataFrame:
    return clean_experiment(raw_experiment(spark, sf, variant))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_kpis(stg_ads(spark, sf))


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return hourly_trends(stg_ads(spark, sf))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    return segment_performance(stg_ads(spark, sf))

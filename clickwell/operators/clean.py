"""Cleaning operators (raw text -> typed staging rows) and their one-pass summaries.

Everything here is a narrow chain of projections and filters (no shuffle) except the
summaries, which are a single conditional aggregation over the pre-filter frame, so
the drop counters, unknown-value counts, CTR and date range cost one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AD_NUMERIC_COLUMNS, SEGMENT_MAP, TREATMENT_LABELS, ZIP_CODE_MAP
from ..functions.core import (any_true, decode_hour_code, is_binary, is_unknown_numeric,
                              is_unknown_string, lenient_double, lenient_int, lookup, na_to_null,
                              strip)
from ..schemas import FLAG_COLUMNS, STG_ADS, STG_EXPERIMENT


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip + lower-case every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def na_normalize(df: DataFrame) -> DataFrame:
    """Missing-value tokens in text columns become null (as a pandas reader does)."""
    return df.select(*[na_to_null(c).alias(c) if t == "string" else F.col(c)
                       for c, t in df.dtypes])


# ------------------------------------------------------------------------ ads

def parse_once(df: DataFrame, **exprs) -> DataFrame:
    """Append computed columns through a one-row ``inline`` generator.

    Catalyst pushes filters below projections by inlining the projected expressions,
    so a filter on a parsed value would re-run the parse (and every later filter on a
    derived column runs it again).  Predicates on a generator's output stay above the
    generator, so each parse runs exactly once per row."""
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))))


def _ads_prepared(raw: DataFrame) -> DataFrame:
    df = parse_once(na_normalize(normalize_columns(raw)),
                    _click=lenient_double("click"), _ts=decode_hour_code("hour"))
    flags = {f"flag_unknown_{c}": (is_unknown_numeric(c) if c == "device_type"
                                   else is_unknown_string(c))
             for c in FLAG_COLUMNS if c in df.columns}
    return df.withColumns({
        "_valid_click": is_binary("_click"),
        **flags,
    }).withColumns({
        "_valid_hour": F.col("_ts").isNotNull(),
        "flag_missing_fields": any_true([F.col(f) for f in flags]),
    })


def clean_ads(raw: DataFrame) -> DataFrame:
    """Raw ad log -> ``stg_ad_events`` rows.

    Drops rows whose click is not 0/1, then rows whose hour code does not decode;
    derives ``event_date`` / ``event_hour``; flags unknown values; coerces numeric
    feature columns leniently (bad text or a value out of range -> null).  ``click`` and
    ``hour`` are required; other columns may be absent: they become null, and their flags
    false.
    """
    return _typed_ads(_ads_prepared(raw).filter(F.col("_valid_click") & F.col("_valid_hour")))


def _typed_ads(df: DataFrame) -> DataFrame:
    typed = {
        "click": F.col("_click").cast("int"),
        "hour": strip("hour").cast("bigint"),
        "event_date": F.to_date("_ts"),
        "event_hour": F.hour("_ts").cast("int"),
    }
    numbers = {"c1": "bigint", "device_type": "int", "banner_pos": "int", "device_conn_type": "int",
               **{c: "double" for c in AD_NUMERIC_COLUMNS if c not in ("banner_pos", "device_conn_type")}}
    for c, kind in numbers.items():
        if c in df.columns:
            typed[c] = lenient_double(c) if kind == "double" else lenient_int(c, kind)
    out = df.withColumns(typed)

    def field(f):
        if f.name in out.columns:
            return F.col(f.name)
        return F.lit(False if f.name in _FLAG_NAMES else None)

    return out.select(*[field(f).cast(f.dataType).alias(f.name) for f in STG_ADS.fields])


_FLAG_NAMES = {f"flag_unknown_{c}" for c in FLAG_COLUMNS}


def _ads_summary_counters(df: DataFrame) -> list:
    kept = F.col("_valid_click") & F.col("_valid_hour")

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    aggs = [
        F.count(F.lit(1)).alias("input_rows"),
        n(kept).alias("output_rows"),
        n(~F.col("_valid_click")).alias("dropped_invalid_click"),
        n(F.col("_valid_click") & ~F.col("_valid_hour")).alias("dropped_invalid_hour"),
        n(kept & F.col("flag_missing_fields")).alias("rows_with_unknown_fields"),
    ]
    aggs += [n(kept & F.col(f"flag_unknown_{c}")).alias(f"unknown_{c}")
             for c in FLAG_COLUMNS if f"flag_unknown_{c}" in df.columns]
    aggs.append(n(kept & (F.col("_click") == 1)).alias("_clicks"))
    return aggs


def _finish_ads_summary(s: DataFrame, dataset: str) -> DataFrame:
    ctr = F.when(F.col("output_rows") == 0, F.lit(0.0)).otherwise(
        F.round(F.col("_clicks") / F.col("output_rows"), 6))
    return (s.withColumns({"dataset": F.lit(dataset),
                           "rows_removed": F.col("input_rows") - F.col("output_rows"),
                           "ctr": ctr,
                           "columns": F.array(*[F.lit(f.name) for f in STG_ADS.fields]),
                           "distinct_days": F.col("distinct_days").cast("bigint")})
            .drop("_clicks"))


def clean_ads_summary(raw: DataFrame, dataset: str = "avazu_mobile_ads") -> DataFrame:
    """C14: one-row cleaning summary (drops by reason, unknown counts, CTR, dates)."""
    df = _ads_prepared(raw)
    kept = F.col("_valid_click") & F.col("_valid_hour")
    date = F.to_date("_ts")
    s = df.agg(*_ads_summary_counters(df),
               F.min(F.when(kept, date)).alias("min_event_date"),
               F.max(F.when(kept, date)).alias("max_event_date"),
               F.countDistinct(F.when(kept, date)).alias("distinct_days"))
    return _finish_ads_summary(s, dataset)


def clean_ads_observed(raw: DataFrame):
    """C13 + C14 in one pass: the staging rows with the summary counters attached as
    an ``Observation`` (filled when the returned frame is written).  Use
    ``observed_ads_summary`` afterwards; the date range and distinct days come from
    the (small) daily mart, since observed metrics cannot hold a distinct count."""
    from pyspark.sql import Observation
    obs = Observation("ads_cleaning_summary")
    prepared = _ads_prepared(raw)
    observed = prepared.observe(obs, *_ads_summary_counters(prepared))
    return _typed_ads(observed.filter(F.col("_valid_click") & F.col("_valid_hour"))), obs


def observed_ads_summary(obs, daily: DataFrame, dataset: str = "avazu_mobile_ads") -> DataFrame:
    """C14 from an ``Observation`` filled by writing ``clean_ads_observed`` output."""
    spark = daily.sparkSession
    counters = obs.get
    row = spark.createDataFrame([tuple(counters.values())],
                                ", ".join(f"`{k}` bigint" for k in counters))
    dates = daily.agg(F.min("event_date").alias("min_event_date"),
                      F.max("event_date").alias("max_event_date"),
                      F.count(F.lit(1)).alias("distinct_days"))
    return _finish_ads_summary(row.crossJoin(F.broadcast(dates)), dataset)


def unknown_flags(raw: DataFrame) -> DataFrame:
    """C7-C10 as a long table: per monitored column, rows flagged unknown among kept rows."""
    stg = clean_ads(raw)
    present = list(FLAG_COLUMNS)
    cols = [F.sum(F.col(f"flag_unknown_{c}").cast("int")).cast("bigint").alias(c)
            for c in present]
    cols.append(F.sum(F.col("flag_missing_fields").cast("int")).cast("bigint")
                .alias("flag_missing_fields"))
    wide = stg.agg(*cols)
    names = present + ["flag_missing_fields"]
    return wide.unpivot([], names, "column_name", "unknown_rows")


# ---------------------------------------------------------------- experiment

def _experiment_prepared(raw: DataFrame, segment_map: dict[str, str]) -> DataFrame:
    df = parse_once(na_normalize(normalize_columns(raw)), _visit=lenient_double("visit"),
                    _conversion=lenient_double("conversion"), _spend=lenient_double("spend"),
                    treatment_group=lookup("segment", segment_map))
    return df.withColumns({
        "_bad_visit": ~is_binary("_visit"),
        "_bad_conversion": ~is_binary("_conversion"),
        "_bad_spend": ~F.coalesce(F.col("_spend") >= 0, F.lit(False)),
    }).withColumn("_valid", F.when(F.col("_bad_visit") | F.col("_bad_conversion") | F.col("_bad_spend"), False)
                  .otherwise(_required()))


#: columns of a valid recipient that must be whole numbers; a bad value stops the run
REQUIRED_INTS = ("recency", "mens", "womens", "newbie")


def _required():
    """True, or an error for a null or unparseable required value.  It is part of the row
    filter, before arms are mapped: an expression in a column would be pruned with it."""
    guard = F.lit(True)
    for c in REQUIRED_INTS:
        guard = F.when(lenient_int(c).isNull(), F.raise_error(F.lit(f"null or bad value in required column {c}"))
                       .cast("boolean")).otherwise(guard)
    return guard


def clean_experiment(raw: DataFrame, segment_map: dict[str, str] | None = None,
                     labels: dict[str, str] | None = None,
                     region_map: dict[str, str] | None = None) -> DataFrame:
    """Raw experiment -> ``stg_email_experiment`` rows."""
    segment_map = segment_map or SEGMENT_MAP
    labels = labels or TREATMENT_LABELS
    return _typed_experiment(_experiment_prepared(raw, segment_map), labels, region_map or ZIP_CODE_MAP)


def _typed_experiment(df: DataFrame, labels: dict[str, str], region_map: dict[str, str]) -> DataFrame:
    df = df.filter(F.col("_valid") & F.col("treatment_group").isNotNull())
    std = lookup("zip_code", region_map)
    out = df.withColumns({
        "recency": lenient_int("recency"),
        "mens": lenient_int("mens"),
        "womens": lenient_int("womens"),
        "newbie": lenient_int("newbie"),
        "history": strip("history").cast("double"),
        "visit": F.col("_visit").cast("int"),
        "conversion": F.col("_conversion").cast("int"),
        "spend": F.col("_spend"),
        "treatment_label": lookup("treatment_group", labels),
        "converted": F.col("_visit").cast("int"),
        "revenue": F.col("_spend"),
        "zip_code_std": std,
    }).withColumns({
        # pandas compares null != value as True, so an unmapped region is also a typo.
        "flag_zip_code_typo": F.coalesce(F.col("zip_code") != F.col("zip_code_std"), F.lit(True)),
        "flag_missing_fields": F.col("zip_code_std").isNull(),
    })
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STG_EXPERIMENT.fields])


def _experiment_counters(df: DataFrame, segment_map: dict[str, str], region_map: dict[str, str]) -> list:
    """Counters of C24: drop reasons, rates and recipients per mapped arm (the arms are
    those of the configured map).  Plain sums, so a write can observe them."""
    kept = F.col("_valid") & F.col("treatment_group").isNotNull()
    std = lookup("zip_code", region_map)
    typo = F.coalesce(F.col("zip_code") != std, F.lit(True))

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    return [
        F.count(F.lit(1)).alias("input_rows"),
        n(kept).alias("output_rows"),
        n(F.col("_bad_visit")).alias("dropped_invalid_visit"),
        n(F.col("_bad_conversion")).alias("dropped_invalid_conversion"),
        n(F.col("_bad_spend")).alias("dropped_invalid_spend"),
        n(F.col("_valid") & F.col("treatment_group").isNull()).alias("dropped_unmapped_segment"),
        n(kept & typo).alias("zip_code_typo_rows"),
        n(kept & std.isNull()).alias("rows_with_unknown_fields"),
        n(kept & (F.col("_visit") == 1)).alias("_visits"),
        n(kept & (F.col("_conversion") == 1)).alias("_conversions"),
        F.sum(F.when(kept, F.col("_spend"))).alias("_revenue"),
    ] + [n(kept & (F.col("treatment_group") == arm)).alias(f"_arm_{arm}") for arm in _arms(segment_map)]


def _arms(segment_map: dict[str, str]) -> list[str]:
    return sorted(set(segment_map.values()))


def _finish_experiment_summary(s: DataFrame, segment_map: dict[str, str], dataset: str) -> DataFrame:
    out_rows = F.col("output_rows")

    def rate(c, digits):
        return F.when(out_rows == 0, F.lit(0.0)).otherwise(F.round(F.col(c) / out_rows, digits))

    counts = F.create_map(*[x for arm in _arms(segment_map) for x in (F.lit(arm), F.col(f"_arm_{arm}"))])
    return s.withColumns({
        "dataset": F.lit(dataset),
        "rows_removed": F.col("input_rows") - out_rows,
        "treatment_group_counts": F.map_filter(counts, lambda k, v: v > 0),
        "visit_rate": rate("_visits", 6),
        "conversion_rate": rate("_conversions", 6),
        "revenue_mean": rate("_revenue", 4),
        "columns": F.array(*[F.lit(f.name) for f in STG_EXPERIMENT.fields]),
    }).drop("_visits", "_conversions", "_revenue", *[f"_arm_{arm}" for arm in _arms(segment_map)])


def clean_experiment_summary(raw: DataFrame, segment_map: dict[str, str] | None = None,
                             region_map: dict[str, str] | None = None,
                             dataset: str = "hillstrom_email_experiment") -> DataFrame:
    """One-row summary.  Drop reasons are counted independently (they overlap);
    unmapped arms are counted among the value-valid rows; ``treatment_group_counts`` maps
    each arm that has recipients to their number, ``columns`` lists the staging columns."""
    segment_map = segment_map or SEGMENT_MAP
    df = _experiment_prepared(raw, segment_map)
    return _finish_experiment_summary(
        df.agg(*_experiment_counters(df, segment_map, region_map or ZIP_CODE_MAP)), segment_map, dataset)


def clean_experiment_observed(raw: DataFrame, segment_map: dict[str, str] | None = None,
                              region_map: dict[str, str] | None = None):
    """C23 + C24 in one pass: the staging rows and an ``Observation`` that holds the
    counters once the rows are written (``observed_experiment_summary``)."""
    from pyspark.sql import Observation
    segment_map, region_map = segment_map or SEGMENT_MAP, region_map or ZIP_CODE_MAP
    obs = Observation("experiment_cleaning_summary")
    df = _experiment_prepared(raw, segment_map)
    df = df.observe(obs, *_experiment_counters(df, segment_map, region_map))
    return _typed_experiment(df, TREATMENT_LABELS, region_map), obs


def observed_experiment_summary(spark, obs, segment_map: dict[str, str] | None = None,
                                dataset: str = "hillstrom_email_experiment") -> DataFrame:
    counters = obs.get
    row = spark.createDataFrame([tuple(counters.values())], ", ".join(
        f"`{k}` {'double' if k == '_revenue' else 'bigint'}" for k in counters))
    return _finish_experiment_summary(row, segment_map or SEGMENT_MAP, dataset)

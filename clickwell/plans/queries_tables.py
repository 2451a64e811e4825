"""Registered queries of the sources and sinks: each writes to a new folder under the shared
checkpoint folder and reads back what it wrote (S1-S16, C25)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import clean
from ..schemas import ADS_RAW_COLUMNS, EXPERIMENT_RAW_TEXT, RAW_ADS, RAW_EXPERIMENT, STG_ADS, TABLES
from ..session import new_folder, write_shared
from ..sources import readers, sinks, versions
from ..sources.adapters import raw_ads, raw_experiment
from .oracle import EXPORTS, with_ctes
from .pipeline import build, export_all, materialize
from .queries_forecast import HOLDOUT
from .queries_quality import RANKING, _qsql, bundle
from .registry import register


def _write_csv(df, path, header=True, compression="none"):
    (df.write.option("header", header).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("escape", '"').option("compression", compression).csv(path))
    return path


# --- S1, S2: CSV bound by header name -------------------------------------------------

@register("csv_round_trip", with_ctes(["raw_ads"], "SELECT {} FROM raw_ads".format(
    ", ".join(f"nullif({c}, '') AS {c}" for c in ADS_RAW_COLUMNS))))
def csv_round_trip(spark, sf):
    """The ad log written with its columns in reverse order, upper-case names and one more
    column, read back by name."""
    rows = raw_ads(spark, sf)
    shuffled = rows.select(*[F.col(c).alias(c.upper()) for c in reversed(rows.columns)], F.lit("x").alias("extra"))
    return readers.read_ads_csv(spark, _write_csv(shuffled, new_folder(spark, "csv")))


# --- S3, S4: strict typed loads ----------------------------------------------------------

_INTS = ("click", "hour", "c1", "banner_pos", "device_type", "device_conn_type")
_STRICT = " AND ".join(f"regexp_full_match({c}, '-?[0-9]+')" for c in _INTS)


def _typed(schema, kinds={"integer": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER"}):
    return ", ".join(f"CAST(nullif({f.name}, '') AS {kinds[f.dataType.simpleString()]}) AS {f.name}" for f in schema.fields)


@register("strict_load_ads", with_ctes(["raw_ads"], f"SELECT {_typed(RAW_ADS)} FROM raw_ads WHERE {_STRICT}"))
def strict_load_ads(spark, sf):
    """The rows whose whole numbers are clean, through a CSV file into the raw table's types."""
    good = raw_ads(spark, sf).filter(" and ".join(f"{c} rlike '^-?[0-9]+$'" for c in _INTS))
    return readers.load_raw_ads(spark, _write_csv(good, new_folder(spark, "csv")))


_EXP_OK = "conversion != '1f' AND spend != 'NAN'"


@register("strict_load_experiment", with_ctes(["raw_experiment"], f"SELECT {_typed(RAW_EXPERIMENT)} FROM raw_experiment WHERE {_EXP_OK}"))
def strict_load_experiment(spark, sf):
    good = raw_experiment(spark, sf).filter(_EXP_OK)
    return readers.load_raw_experiment(spark, _write_csv(good, new_folder(spark, "csv")))


# --- S7, S8: compressed files and import ---------------------------------------------------

_EXP_TEXT = "SELECT {} FROM raw_experiment".format(", ".join(
    f"nullif({f.name}, '') AS {f.name}" for f in EXPERIMENT_RAW_TEXT.fields))


@register("gzip_read", with_ctes(["raw_experiment"], _EXP_TEXT))
def gzip_read(spark, sf):
    """All rows of gzip files without header lines."""
    path = _write_csv(raw_experiment(spark, sf), new_folder(spark, "gzip"), header=False, compression="gzip")
    return readers.read_gzip_sample(spark, path, None, EXPERIMENT_RAW_TEXT)


@register("import_csv", with_ctes(["raw_experiment"], _EXP_TEXT))
def import_csv(spark, sf):
    """A CSV copied whole to a new place; the copy is what is returned."""
    source = _write_csv(raw_experiment(spark, sf), new_folder(spark, "csv"))
    return readers.import_csv(spark, source, new_folder(spark, "import"), schema=EXPERIMENT_RAW_TEXT)


@register("gzip_sample", with_ctes(["raw_ads"], """
SELECT least(500, count(*)) AS n_rows, least(500, count(*)) AS n_in_source, CAST(0 AS BIGINT) AS n_header FROM raw_ads"""))
def gzip_sample(spark, sf):
    """500 rows of gzip files with header lines; all are rows of the source, none a header."""
    rows = raw_ads(spark, sf)
    path = _write_csv(rows, new_folder(spark, "gzip"), header=True, compression="gzip")
    got = readers.read_gzip_sample(spark, path, 500, rows.schema)
    known = rows.select(F.col("id").alias("known")).distinct()
    return got.join(known, F.col("id") == F.col("known"), "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("known").alias("n_in_source"), F.count_if(F.col("id") == "id").alias("n_header"))


@register("import_skip_force", with_ctes(["raw_experiment"], """
SELECT unnest([1, 2, 3]) AS step, unnest([least(100, count(*)), least(100, count(*)), count(*)]) AS row_count FROM raw_experiment"""))
def import_skip_force(spark, sf):
    """The first 100 rows; the whole file, skipped as the target exists; the whole file by force."""
    rows = raw_experiment(spark, sf)
    source, target = _write_csv(rows, new_folder(spark, "csv")), new_folder(spark, "import")
    counts = [readers.import_csv(spark, source, target, rows=n, schema=EXPERIMENT_RAW_TEXT, force=force).count()
              for n, force in ((100, False), (None, False), (None, True))]
    return spark.createDataFrame(list(enumerate(counts, 1)), "step int, row_count bigint")


# --- S5, S6, S10: staging, full refresh -----------------------------------------------------

@register("full_refresh", with_ctes(["stg_ads"], "SELECT * FROM stg_ads WHERE day(event_date) % 2 = 1"))
def full_refresh(spark, sf):
    """Staging written for the even days, then refreshed with the odd days: only the second
    run's rows are there."""
    stg = clean.clean_ads(raw_ads(spark, sf))
    path = new_folder(spark, "staging")
    for rest in (0, 1):
        sinks.write_table(stg.filter(F.day("event_date") % 2 == rest), path, partition_by=("event_date",))
    return readers.read_staging(spark, path, STG_ADS)


@register("date_refresh", with_ctes(["stg_ads"], """
SELECT event_date, count(*) AS row_count, sum(CASE WHEN day(event_date) % 2 = 1 THEN 2 ELSE 1 END) AS run_sum
FROM stg_ads GROUP BY event_date""").replace("sum(CASE", "CAST(sum(CASE").replace("END) AS run_sum", "END) AS BIGINT) AS run_sum"))
def date_refresh(spark, sf):
    """All days written, then the odd days replaced: the even days stay as they were."""
    stg = clean.clean_ads(raw_ads(spark, sf))
    path = new_folder(spark, "staging")
    sinks.write_table(stg.withColumn("run", F.lit(1)), path, partition_by=("event_date",))
    sinks.refresh_dates(stg.withColumn("run", F.lit(2)).filter(F.day("event_date") % 2 == 1), path, ("event_date",))
    return spark.read.parquet(path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("run").alias("run_sum"))


# --- S9, S11, S12: loads, contracts, inventory ---------------------------------------------

def _stored(spark, sf):
    """Sources of a load: raw CSV files and cleaned Parquet, as (table, layer, path, type, reader)."""
    ads = raw_ads(spark, sf).filter(" and ".join(f"{c} rlike '^-?[0-9]+$'" for c in _INTS))
    exp = raw_experiment(spark, sf, "contrast")
    base = new_folder(spark, "sources")
    clean.clean_ads(raw_ads(spark, sf)).write.parquet(f"{base}/stg_ads")
    clean.clean_experiment(exp).write.parquet(f"{base}/stg_exp")
    staging = lambda name: lambda s, p: readers.read_staging(s, p, TABLES[name][1])
    return [
        sinks.LoadTarget("raw_avazu_ads", "raw", _write_csv(ads, f"{base}/ads"), "csv", readers.load_raw_ads),
        sinks.LoadTarget("raw_hillstrom_email", "raw", _write_csv(exp.filter(_EXP_OK), f"{base}/exp"), "csv", readers.load_raw_experiment),
        sinks.LoadTarget("stg_ad_events", "staging", f"{base}/stg_ads", "parquet", staging("stg_ad_events"), ("event_date",)),
        sinks.LoadTarget("stg_email_experiment", "staging", f"{base}/stg_exp", "parquet", staging("stg_email_experiment")),
    ]


# --- fixed names of the contract ---------------------------------------------------------
_LOADED = (("raw_avazu_ads", "raw", "csv", f"raw_ads WHERE {_STRICT}"),
           ("raw_hillstrom_email", "raw", "csv", f"raw_experiment WHERE {_EXP_OK}"),
           ("stg_ad_events", "staging", "parquet", "stg_ads"), ("stg_email_experiment", "staging", "parquet", "stg_exp"))


@register("load_audit", _qsql("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{layer}' AS layer, '{kind}' AS source_type, count(*) AS row_count, "
    f"'success' AS status, CAST(NULL AS VARCHAR) AS error FROM {src}" for t, layer, kind, src in _LOADED)))
def load_audit(spark, sf):
    """Four tables loaded into a new warehouse; the audit that the load returns (without the
    sources' paths)."""
    return sinks.load_data(spark, _stored(spark, sf), new_folder(spark, "warehouse")).drop("source")


_SQL_TABLE = {"stg_ad_events": "stg_ads", "stg_email_experiment": "stg_exp", "mart_campaign_kpis": "daily",
              "mart_ctr_trends": "hourly", "mart_device_app_performance": "segments", "mart_ab_test_results": "abp",
              "mart_forecast_inputs": "hourly", "mart_forecast_results": "results", "recommendations_summary": "recs"}
# -------------------------------------------------------------------------------------------
_LAYERS = {t: layer for t, (layer, _) in TABLES.items() if layer != "raw"}


@register("table_inventory", _qsql("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{layer}' AS layer, count(*) AS row_count FROM {_SQL_TABLE[t]}"
    for t, layer in _LAYERS.items())))
def table_inventory(spark, sf):
    """Staging and marts written to a new warehouse, then counted there."""
    folder = new_folder(spark, "warehouse")
    materialize(build(raw_ads(spark, sf), raw_experiment(spark, sf, "contrast"), RANKING, holdout_hours=HOLDOUT), folder)
    return sinks.table_inventory(spark, folder, _LAYERS)


# --- S13-S16: exports -------------------------------------------------------------------------

@register("export_manifest", _qsql("\nUNION ALL ".join(
    f"SELECT '{f}' AS file, '{src}' AS source, '{text}' AS description, count(*) AS row_count, "
    f"'exports/{f}' AS relative_path FROM {_SQL_TABLE[src]}" for f, src, text in EXPORTS)))
def export_manifest(spark, sf):
    """The manifest of an export of all marts to two zones; counts are those of the writes."""
    b = bundle(spark, sf)
    return export_all(b, write_shared(b.recommendations), (new_folder(spark, "marts"), new_folder(spark, "exports")))


@register("export_read_back", _qsql("SELECT 'segment_performance.csv' AS file, * FROM segments"))
def export_read_back(spark, sf):
    """The segment mart as read back from the second zone."""
    zones = (new_folder(spark, "marts"), new_folder(spark, "exports"))
    b = bundle(spark, sf)
    sinks.export_mart(b.segments, "segment_performance.csv", zones, list(b.ranking.dims))
    back = readers.read_exports(spark, {"segments": (f"{zones[1]}/segment_performance.csv", TABLES["mart_device_app_performance"][1])})
    return back["segments"].select(F.lit("segment_performance.csv").alias("file"), "*")


@register("export_without_stamp", with_ctes(["daily"], "SELECT * FROM daily"))
def export_without_stamp(spark, sf):
    """The daily mart as it stands in the warehouse, stamped, exported and read back with the
    columns that the file has: the stamp is left out."""
    b = materialize(build(raw_ads(spark, sf), raw_experiment(spark, sf, "contrast"), RANKING, holdout_hours=HOLDOUT),
                    folder := new_folder(spark, "warehouse"))
    stamped = spark.read.parquet(f"{folder}/mart_campaign_kpis")
    assert "created_at" in stamped.columns and "created_at" not in b.daily.columns
    path = new_folder(spark, "exports")
    sinks.export_mart(stamped, "campaign_kpis.csv", (path,), ["event_date"])
    text = spark.read.option("header", True).csv(f"{path}/campaign_kpis.csv")
    kinds = {f.name: f.dataType for f in TABLES["mart_campaign_kpis"][1].fields}
    return text.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in text.columns])


# --- atomic publish ---------------------------------------------------------------------------

def _published(spark, sf):
    """A warehouse with three loads: staging of the even days, a load that fails in its third table,
    staging of all days; the audits of the loads are returned too."""
    warehouse, base = new_folder(spark, "published"), new_folder(spark, "sources")
    stg, exp = clean.clean_ads(raw_ads(spark, sf)), clean.clean_experiment(raw_experiment(spark, sf, "contrast"))
    exp.write.parquet(f"{base}/stg_exp")
    stg.write.parquet(f"{base}/all")
    stg.filter(F.day("event_date") % 2 == 0).write.parquet(f"{base}/even")
    bad = _write_csv(raw_ads(spark, sf), f"{base}/raw")      # has clicks that are not numbers
    staging = lambda name: lambda s, p: readers.read_staging(s, p, TABLES[name][1])
    target = lambda name, part: sinks.LoadTarget(name, "staging", f"{base}/{part}", "parquet", staging(name))
    raw = sinks.LoadTarget("raw_avazu_ads", "raw", bad, "csv", readers.load_raw_ads)
    experiment = target("stg_email_experiment", "stg_exp")
    loads = ((target("stg_ad_events", "even"), experiment), (target("stg_ad_events", "all"), experiment, raw),
             (target("stg_ad_events", "all"),))
    return warehouse, [versions.load_data(spark, load, warehouse) for load in loads]


@register("publish_versions", with_ctes(["stg_ads", "stg_exp"], """
SELECT 1 AS version, 'stg_ad_events' AS table_name, count(*) AS row_count FROM stg_ads WHERE day(event_date) % 2 = 0
UNION ALL SELECT 2, 'stg_ad_events', count(*) FROM stg_ads
UNION ALL SELECT unnest([1, 2]), 'stg_email_experiment', count(*) FROM stg_exp"""))
def publish_versions(spark, sf):
    """Rows of every table of every version that was published: the load that failed published none."""
    warehouse, _ = _published(spark, sf)
    rows = [versions.read_table(spark, warehouse, t, v.number).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(v.number).alias("version"), F.lit(t).alias("table_name"), "row_count")
        for v in versions.history(spark, warehouse) for t in sorted(v.tables)]
    return reduce(lambda a, b: a.unionByName(b), rows)


@register("publish_audit", with_ctes(["stg_ads", "stg_exp"], """
SELECT 1 AS load, 'stg_ad_events' AS table_name, count(*) AS row_count, 'success' AS status FROM stg_ads WHERE day(event_date) % 2 = 0
UNION ALL SELECT unnest([2, 3]), 'stg_ad_events', count(*), 'success' FROM stg_ads
UNION ALL SELECT unnest([1, 2]), 'stg_email_experiment', count(*), 'success' FROM stg_exp
UNION ALL SELECT 2, 'raw_avazu_ads', NULL, 'failed'"""))
def publish_audit(spark, sf):
    """The audits of the three loads; the second fails in its third table."""
    _, done = _published(spark, sf)
    return reduce(lambda a, b: a.unionByName(b), [
        audit.select(F.lit(k).alias("load"), "table_name", "row_count", "status") for k, (audit, _) in enumerate(done, 1)])


@register("publish_rollback", with_ctes(["stg_ads"], "SELECT * FROM stg_ads WHERE day(event_date) % 2 = 0"))
def publish_rollback(spark, sf):
    """Staging as read after the first version is published again."""
    warehouse, _ = _published(spark, sf)
    versions.rollback(spark, warehouse, 1)
    return versions.read_table(spark, warehouse, "stg_ad_events")


# --- C25, S17: summary store ----------------------------------------------------------------

_KEPT_ADS = "_valid_click AND _valid_hour"
_KEPT_EXP = "NOT (_bad_visit OR _bad_conversion OR _bad_spend) AND treatment_group IS NOT NULL"


@register("clean_summary_upsert", with_ctes(["ads_prep", "exp_prep"], f"""
SELECT 'avazu_mobile_ads' AS dataset, count(*) AS input_rows, count(*) FILTER ({_KEPT_ADS}) AS output_rows,
       CAST(min(CAST(_ts AS DATE)) FILTER ({_KEPT_ADS}) AS DATE) AS min_event_date,
       CAST({len(STG_ADS.fields)} AS BIGINT) AS n_columns
FROM ads_prep
UNION ALL
SELECT 'hillstrom_email_experiment', count(*), count(*) FILTER ({_KEPT_EXP}), NULL,
       CAST({len(TABLES["stg_email_experiment"][1].fields)} AS BIGINT)
FROM exp_prep"""))
def clean_summary_upsert(spark, sf):
    """Both datasets' summaries put into one keyed store, one of them twice; the stored rows
    with their own types."""
    path = new_folder(spark, "cleaning_summary")
    exp = clean.clean_experiment_summary(raw_experiment(spark, sf))
    ads = clean.clean_ads_summary(raw_ads(spark, sf))
    sinks.merge_summary(spark, ads.withColumn("input_rows", F.lit(-1).cast("bigint")), "avazu_mobile_ads", path)
    stored = (sinks.merge_summary(spark, exp, "hillstrom_email_experiment", path).withColumn("min_event_date", F.lit(None).cast("date")),
              sinks.merge_summary(spark, ads, "avazu_mobile_ads", path))
    cols = ["dataset", "input_rows", "output_rows", "min_event_date", F.size("columns").cast("bigint").alias("n_columns")]
    return stored[0].select(*cols).unionByName(stored[1].select(*cols))

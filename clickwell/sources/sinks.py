"""Sinks and table management.

Writes go to any Hadoop-compatible URI (local path, ``hdfs://``, ``s3a://``).  Row
counts for audits and manifests come from ``DataFrame.observe`` on the write itself,
so a load or export scans its input once.  Full refresh is a static overwrite: dates
that are not in the new data are gone afterwards.  Replacing single dates is a refresh of
its own (``refresh_dates``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import RECOMMENDATIONS


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite", fmt: str = "parquet", header: bool = True,
                overwrite: str = "static") -> int:
    """Write ``df`` and return the number of rows written (observed).  With
    ``partition_by`` the rows are rebalanced by partition first, so the number of files
    follows the data's size, not tasks times partitions, and a large partition is split."""
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        observed = observed.hint("rebalance", *[F.col(c) for c in partition_by])
    w = observed.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    if partition_by:
        w = w.option("partitionOverwriteMode", overwrite).partitionBy(*partition_by)
    w.save(path)
    return int(obs.get.get("rows", 0))


def refresh_dates(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace only the partitions that ``df`` holds; the others stay as they are."""
    return write_table(df, path, partition_by, overwrite="dynamic")


@dataclass(frozen=True)
class LoadTarget:
    """One table load: ``reader`` builds the typed DataFrame from ``source``."""
    table: str
    layer: str
    source: str
    source_type: str
    reader: object  # Callable[[SparkSession, str], DataFrame]
    partition_by: tuple[str, ...] = ()


def load_data(spark: SparkSession, targets: Iterable[LoadTarget], warehouse: str) -> DataFrame:
    """Clear all targets, load each into ``warehouse/<table>``, stopping at the first
    failure; returns the audit table (table, layer, source, type, row_count, status,
    error).  A source that does not exist is refused before anything is cleared."""
    targets = list(targets)
    absent = [t.source for t in targets if not path_exists(spark, t.source)]
    if absent:
        raise FileNotFoundError("Missing sources: " + ", ".join(absent))
    for t in targets:
        delete_path(spark, f"{warehouse.rstrip('/')}/{t.table}")
    rows = []
    for t in targets:
        try:
            n = write_table(t.reader(spark, t.source), f"{warehouse.rstrip('/')}/{t.table}",
                            t.partition_by)
            rows.append((t.table, t.layer, t.source, t.source_type, n, "success", None))
        except Exception as exc:  # noqa: BLE001 - the audit records the failure
            rows.append((t.table, t.layer, t.source, t.source_type, None, "failed",
                         f"{type(exc).__name__}: {exc}"))
            break
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


AUDIT_SCHEMA = ("table_name string, layer string, source string, source_type string, "
                "row_count bigint, status string, error string")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def table_inventory(spark: SparkSession, warehouse: str, layers: dict[str, str]) -> DataFrame:
    """(table_name, layer, row_count) of the tables found in a warehouse; tables that
    are not there are all named in one error.  Counts come from the files' metadata."""
    base = warehouse.rstrip("/")
    missing = [n for n in layers if not path_exists(spark, f"{base}/{n}")]
    if missing:
        raise RuntimeError(f"Missing tables: {', '.join(missing)}")
    out = None
    for name, layer in layers.items():
        row = spark.read.parquet(f"{base}/{name}").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(layer).alias("layer"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def export_mart(df: DataFrame, file_name: str, zones: Sequence[str],
                order_by: Sequence[str]) -> int:
    """Mart without ``created_at`` as CSV (header), sorted, written to every zone by
    the executors; returns its rows.  The sort range-partitions the output instead of
    forcing it into one task.  ``df`` should be a written mart, as each zone reads it."""
    out = df.drop("created_at")
    out = out.orderBy(*order_by) if order_by else out
    return [write_table(out, f"{zone.rstrip('/')}/{file_name}", fmt="csv") for zone in zones][0]


def recommendation_matrix(recs: DataFrame) -> DataFrame:
    """The fixed six-column order; absent columns become null."""
    return recs.select(*[F.col(f.name) if f.name in recs.columns
                         else F.lit(None).cast("string").alias(f.name)
                         for f in RECOMMENDATIONS.fields])


def export_manifest(spark: SparkSession, exports: Iterable[tuple[str, str, str, int]],
                    exports_dir: str = "exports") -> DataFrame:
    """(file, source, description, row_count, relative_path) per export, with the row
    counts that the export writes returned."""
    return spark.createDataFrame(
        [(f, source, text, n, f"{exports_dir.rstrip('/')}/{f}") for f, source, text, n in exports],
        "file string, source string, description string, row_count bigint, relative_path string")


def merge_summary(spark: SparkSession, summary: DataFrame, dataset: str, path: str) -> DataFrame:
    """Upsert one dataset's summary into a keyed store (one JSON partition per
    ``dataset``; other datasets are kept).  Returns that dataset's stored row, read back
    with the summary's own types."""
    stamped = summary.drop("dataset").withColumn("generated_at", F.current_timestamp())
    (stamped.withColumn("dataset", F.lit(dataset))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dataset").json(path))
    return read_summary(spark, path, dataset, stamped.schema)


def read_summary(spark: SparkSession, path: str, dataset: str, schema) -> DataFrame:
    """One dataset's row of the summary store, with the given column types."""
    return spark.read.schema(schema).json(f"{path.rstrip('/')}/dataset={dataset}").withColumn("dataset", F.lit(dataset))

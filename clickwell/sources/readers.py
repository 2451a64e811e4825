"""Sources (S1-S5, S7, S8, S16, S17).

Raw files are read as text with an explicit all-string schema (no inference: ids can
exceed 64-bit, and one bad value must not change a column's type), then typed by the
cleaning operators.  Strict loads cast under ANSI mode, so a bad value fails the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ADS_RAW_TEXT, EXPERIMENT_RAW_TEXT, RAW_ADS, RAW_EXPERIMENT


def _csv(spark: SparkSession, header: bool):
    """Reader of text columns that fails on a ragged row or on a header that differs
    between files.  (With column pruning the parser would not count the fields.)"""
    return (spark.read.option("header", header).option("enforceSchema", False).option("mode", "FAILFAST")
            .option("columnPruning", False).option("escape", '"').option("nullValue", ""))


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = ADS_RAW_TEXT) -> DataFrame:
    """Header CSV as text columns (empty field -> null), bound by header name:
    any column order, letter case and further columns are accepted; a missing column or a
    ragged row is an error.  Missing-value tokens are normalised by the cleaning step
    (``clean.na_normalize``)."""
    names = spark.read.option("header", True).option("escape", '"').csv(path).columns
    by_name = {n.strip().lower(): n for n in names}
    missing = [f.name for f in schema.fields if f.name.lower() not in by_name]
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = _csv(spark, header=True).schema(text).csv(path)
    return rows.select(*[F.col(f"`{by_name[f.name.lower()]}`").alias(f.name) for f in schema.fields])


def read_ads_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_raw_csv(spark, path, ADS_RAW_TEXT)


def read_experiment_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_raw_csv(spark, path, EXPERIMENT_RAW_TEXT)


def strict_load(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every column by name to the raw table type; under ANSI a value
    that does not cast fails the load (no silent nulls)."""
    cols = {c.lower(): c for c in text.columns}
    return text.select(*[F.trim(F.col(cols[f.name])).cast(f.dataType).alias(f.name)
                         if isinstance(f.dataType, (T.NumericType,))
                         else F.col(cols[f.name]).cast(f.dataType).alias(f.name)
                         for f in schema.fields])


def load_raw_ads(spark: SparkSession, path: str) -> DataFrame:
    return strict_load(read_ads_csv(spark, path), RAW_ADS)


def load_raw_experiment(spark: SparkSession, path: str) -> DataFrame:
    return strict_load(read_experiment_csv(spark, path), RAW_EXPERIMENT)


def read_staging(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Cleaned Parquet reconciled to the staging contract by column name."""
    return spark.read.parquet(path).to(schema)


def read_gzip_sample(spark: SparkSession, path: str, rows: int | None,
                     schema: T.StructType = ADS_RAW_TEXT, partitions: int | None = None) -> DataFrame:
    """Gzip CSV whose header line is optional (a data row whose first field is the
    first column's name is a header); keep the first ``rows`` data rows of the file, in
    file order.  gzip is not splittable, so one task reads the file anyway, and the frame is
    repartitioned after the read."""
    first = schema.fields[0].name
    df = (_csv(spark, header=False).schema(schema).csv(path)
          .filter(~F.col(first).eqNullSafe(F.lit(first))))
    if rows is not None:
        df = df.limit(rows)
    n = partitions or spark.sparkContext.defaultParallelism
    return df.repartition(n)


def first_rows(spark: SparkSession, rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in file order, without passing them through one task: rows are
    numbered within their split, splits are counted (one number each), and a split keeps
    what the splits before it leave.  ``rows`` comes straight from a file."""
    placed = rows.select("*", F.monotonically_increasing_id().alias("__at"))
    split = F.shiftright("__at", 33)
    counts = sorted((r[0], r[1]) for r in placed.groupBy(split.alias("s")).agg(F.count("*")).collect())
    left, keep = n, {}
    for s, count in counts:
        keep[s] = min(left, count)
        left -= keep[s]
    limits = spark.createDataFrame(list(keep.items()), "__split long, __keep long")
    return (placed.join(F.broadcast(limits), split == F.col("__split"))
            .filter(F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) < F.col("__keep"))
            .drop("__at", "__split", "__keep"))


def import_csv(spark: SparkSession, source: str, destination: str, rows: int | None = None,
               schema: T.StructType = ADS_RAW_TEXT, force: bool = False) -> DataFrame:
    """Copy a CSV (whole or the first ``rows`` rows of the file) to ``destination``; an existing
    destination is kept unless ``force``.  A missing source raises."""
    df = read_raw_csv(spark, source, schema)
    if rows is not None:
        df = first_rows(spark, df, rows)
    df.write.mode("overwrite" if force else "ignore").option("header", True).csv(destination)
    return read_raw_csv(spark, destination, schema)


def read_json_summary(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Summary documents read back as expectations; a missing path raises."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_exports(spark: SparkSession, paths: dict[str, tuple[str, T.StructType]]) -> dict[str, DataFrame]:
    """Exported CSVs read back with their mart schemas; lists every missing file
    in one error."""
    jvm = spark.sparkContext._jvm  # Hadoop FileSystem existence check
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for name, (p, _) in paths.items():
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            missing.append(p)
    if missing:
        raise FileNotFoundError("Missing exports: " + ", ".join(missing))
    return {name: spark.read.schema(s).option("header", True).csv(p)
            for name, (p, s) in paths.items()}

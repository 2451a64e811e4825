"""Spark session helpers.

The library never creates its own session inside an operator; callers pass one in.
``local_session`` is what the tests and the bench use, ``cli_session`` what the command
line does.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session (the shared
folder a cluster names).  Without that setting a local session uses a fresh scratch
folder, as in tests; on a cluster it is an error, since executors do not share local
folders.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "clickwell") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cli_session(app_name: str = "clickwell") -> SparkSession:
    """The session that ``spark-submit`` configures; without one, a local session."""
    if SparkConf().contains("spark.master"):
        builder = SparkSession.builder.appName(app_name)
        for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
            builder = builder.config(key, DEFAULT_CONF[key])
        return builder.getOrCreate()
    return local_session(app_name=app_name)


_FALLBACK_DIRS: dict[str, str] = {}
_LOCK = threading.Lock()
_WRITTEN: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or in local mode
    without that setting one scratch folder per application."""
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    with _LOCK:
        if app not in _FALLBACK_DIRS:
            _FALLBACK_DIRS[app] = tempfile.mkdtemp(prefix="clickwell-ckpt-",
                                                   dir=os.environ.get("TMPDIR", "/tmp"))
        return _FALLBACK_DIRS[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder under the shared folder; ``remove_shared`` deletes it."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with _LOCK:
        _WRITTEN.append(path)
    return path


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SMALL: dict[str, tuple[int, str]] = {}     # application: writes under way, and the setting before them


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000):
    """Arrow batches of at most ``rows`` rows for the jobs that run inside: whole texts go to the
    Python workers, and Spark's default of 10,000 of them takes a hundred MB a task on both sides.  The
    setting is put back when the last of several concurrent writes has ended."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        n, before = _SMALL.get(app, (0, spark.conf.get(_BATCH)))
        _SMALL[app] = (n + 1, before)
        if n == 0 and not 0 < int(before) <= rows:
            spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        with _LOCK:
            n, before = _SMALL.pop(app)
            if n > 1:
                _SMALL[app] = (n - 1, before)
            else:
                spark.conf.set(_BATCH, before)


def write_shared(df):
    """Cut lineage by writing ``df`` once as Parquet to a new folder under the shared
    checkpoint directory and reading it back.  One job (a reliable RDD checkpoint
    computes the data twice unless it is also cached); the result survives executor
    loss and is columnar for the readers that follow."""
    spark = df.sparkSession
    path = new_folder(spark, "shared")
    with small_batches(spark):
        df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_shared(spark: SparkSession) -> int:
    """Delete every folder that ``new_folder`` and ``write_shared`` made in this process.
    For the end of a run: DataFrames that still read them cannot be used afterwards."""
    with _LOCK:
        paths, _WRITTEN[:] = list(_WRITTEN), []
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)

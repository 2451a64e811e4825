"""Atomic publish: a warehouse whose tables change together or not at all.

Every load writes all its tables to a folder of its own, ``versions/<n>/<table>``.  Only when
the last table is complete is the version committed, by creating ``commits/<n>``, a small file
that names the version.  Readers take the highest commit, so a load that fails in any table
leaves what was published before as it is, and a reader never sees tables of two loads.

The commit is one file creation that fails if the file is there, which is atomic on HDFS
and on object stores with conditional puts; of two loads that race for a number one gets it, and the other is
told so and leaves nothing published.  Earlier versions stay for ``keep`` commits;
``rollback`` publishes one of them again as a new commit, without copying it.

Defined cases: a warehouse without commits has no version (an error that says so); tables
that a load does not name are carried over from the published version by reference.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .sinks import AUDIT_SCHEMA, LoadTarget, _file_system, delete_path, path_exists, write_table


class CommitConflict(RuntimeError):
    """Another load has taken the commit number."""


@dataclass(frozen=True)
class Version:
    number: int
    tables: dict[str, str]      # table name to its folder, below the warehouse
    source: str                 # the load or rollback that made it


def _base(warehouse: str) -> str:
    return warehouse.rstrip("/")


def _numbers(spark: SparkSession, warehouse: str) -> list[int]:
    path = f"{_base(warehouse)}/commits"
    if not path_exists(spark, path):
        return []
    fs, p = _file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def _read_commit(spark: SparkSession, warehouse: str, number: int) -> Version:
    fs, p = _file_system(spark, f"{_base(warehouse)}/commits/{number:012d}")
    stream = fs.open(p)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    d = json.loads(text)
    return Version(number, d["tables"], d["source"])


def _create_commit(spark: SparkSession, warehouse: str, version: Version) -> None:
    fs, p = _file_system(spark, f"{_base(warehouse)}/commits/{version.number:012d}")
    body = json.dumps({"tables": version.tables, "source": version.source}).encode()
    try:
        stream = fs.create(p, False)        # fails if the file exists
    except Exception as exc:
        raise CommitConflict(f"version {version.number} of {warehouse} was published by another load") from exc
    try:
        stream.write(bytearray(body))
    finally:
        stream.close()


def history(spark: SparkSession, warehouse: str) -> list[Version]:
    """All commits that are still there, oldest first."""
    return [_read_commit(spark, warehouse, n) for n in _numbers(spark, warehouse)]


def current(spark: SparkSession, warehouse: str, number: int | None = None) -> Version:
    """The published version, or an earlier one by its number."""
    numbers = _numbers(spark, warehouse)
    if not numbers or (number is not None and number not in numbers):
        raise LookupError(f"no published version{'' if number is None else f' {number}'} in {warehouse}")
    return _read_commit(spark, warehouse, numbers[-1] if number is None else number)


def read_table(spark: SparkSession, warehouse: str, table: str, number: int | None = None) -> DataFrame:
    """A table of the published version, or of an earlier one."""
    version = current(spark, warehouse, number)
    if table not in version.tables:
        raise LookupError(f"version {version.number} of {warehouse} has no table {table}")
    return spark.read.parquet(f"{_base(warehouse)}/{version.tables[table]}")


def load_data(spark: SparkSession, targets: Iterable[LoadTarget], warehouse: str, keep: int = 3) -> tuple[DataFrame, Version | None]:
    """Load all targets into a new version and publish it; returns the audit table (as
    ``sinks.load_data``) and the version, None if a load failed.  After a failure the new
    version's folder is removed and the published version is untouched.  A source that does not
    exist is refused before anything is written."""
    targets = list(targets)
    absent = [t.source for t in targets if not path_exists(spark, t.source)]
    if absent:
        raise FileNotFoundError("Missing sources: " + ", ".join(absent))
    numbers = _numbers(spark, warehouse)
    before = current(spark, warehouse).tables if numbers else {}
    number = numbers[-1] + 1 if numbers else 1
    folder = f"versions/{number:012d}-{uuid.uuid4().hex[:12]}"
    rows, tables = [], dict(before)
    for t in targets:
        try:
            n = write_table(t.reader(spark, t.source), f"{_base(warehouse)}/{folder}/{t.table}", t.partition_by)
            rows.append((t.table, t.layer, t.source, t.source_type, n, "success", None))
            tables[t.table] = f"{folder}/{t.table}"
        except Exception as exc:  # noqa: BLE001 - the audit records the failure
            rows.append((t.table, t.layer, t.source, t.source_type, None, "failed", f"{type(exc).__name__}: {exc}"))
            delete_path(spark, f"{_base(warehouse)}/{folder}")
            return spark.createDataFrame(rows, AUDIT_SCHEMA), None
    version = Version(number, tables, "load")
    try:
        _create_commit(spark, warehouse, version)
    except CommitConflict:
        delete_path(spark, f"{_base(warehouse)}/{folder}")
        raise
    expire(spark, warehouse, keep)
    return spark.createDataFrame(rows, AUDIT_SCHEMA), version


def rollback(spark: SparkSession, warehouse: str, number: int) -> Version:
    """Publish an earlier version again; its tables are referred to, not copied."""
    old = current(spark, warehouse, number)
    version = Version(_numbers(spark, warehouse)[-1] + 1, old.tables, f"rollback to {number}")
    _create_commit(spark, warehouse, version)
    return version


def expire(spark: SparkSession, warehouse: str, keep: int) -> list[int]:
    """Drop all but the newest ``keep`` commits and the table folders that no commit is left to refer
    to; returns the numbers dropped.  Folders of loads that are still being written have no
    commit yet and a number beyond the newest, so they stay."""
    if keep < 1:
        raise ValueError("the published version must be kept")
    versions = history(spark, warehouse)
    old, kept = versions[:-keep], versions[-keep:]
    for v in old:
        delete_path(spark, f"{_base(warehouse)}/commits/{v.number:012d}")
    needed = {path for v in kept for path in v.tables.values()}
    for path in {p for v in old for p in v.tables.values()} - needed:
        delete_path(spark, f"{_base(warehouse)}/{path}")
    return [v.number for v in old]

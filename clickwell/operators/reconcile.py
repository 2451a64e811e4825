"""Multiset reconciliation: which rows two tables do not have in common, and how often.

EXCEPT ALL both ways and INTERSECT ALL would each shuffle both tables; here one keyed
count-difference answers all three.  Rows of both sides are put under each other with a
mark, equal rows are counted per side, and rows whose counts differ are the result.
Counting has a map-side part, so a row that is repeated a million times is one row a task, and
whatever the two sides agree on leaves the job as counts.

Rows are equal as SQL groups them: null equals null, NaN equals NaN, -0.0 equals 0.0.
Columns are matched by name and must be the same on both sides; columns of types that cannot be
grouped (maps) are refused.  Two empty tables agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _counted(left: DataFrame, right: DataFrame, columns: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    names = list(columns or left.columns)
    missing = [c for c in names if c not in left.columns or c not in right.columns]
    if columns is None:
        missing += [c for c in right.columns if c not in left.columns]
    if missing:
        raise ValueError("not a column of both tables: " + ", ".join(sorted(set(missing))))
    fields = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]
    both = left.select(*fields, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*fields, F.lit(0).alias("l"), F.lit(1).alias("r")))
    keys = [f"c{k}" for k in range(len(names))]
    return both.groupBy(*keys).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right")), names


def differences(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows whose numbers differ, with ``n_left`` and ``n_right``; ``columns`` limits what is compared."""
    counted, names = _counted(left, right, columns)
    return counted.filter("n_left <> n_right").select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)], "n_left", "n_right")


def summary(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows of both sides, rows in common (INTERSECT ALL), only left and only right
    (EXCEPT ALL both ways), and how many different rows disagree."""
    counted, _ = _counted(left, right, columns)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    l, r = F.col("n_left"), F.col("n_right")
    return counted.agg(total(l).alias("left_rows"), total(r).alias("right_rows"), total(F.least(l, r)).alias("common"),
                       total(F.greatest(l - r, F.lit(0))).alias("only_left"), total(F.greatest(r - l, F.lit(0))).alias("only_right"),
                       F.count_if(l != r).alias("distinct_differences"))


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of ``left`` that ``right`` does not match one for one."""
    return _repeat(*_counted(left, right, None), F.col("n_left") - F.col("n_right"))


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows that both tables have, as often as both have them."""
    return _repeat(*_counted(left, right, None), F.least("n_left", "n_right"))


def _repeat(counted: DataFrame, names: list[str], times: Column) -> DataFrame:
    row = F.struct(*[F.col(f"c{k}") for k in range(len(names))]).alias("row")
    many = counted.filter(times > 0).select(row, F.explode(F.sequence(F.lit(1).cast("long"), times.cast("long"))))
    return many.select(*[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(names)])

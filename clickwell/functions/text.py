"""Text formatting for recommendation evidence and presentation tables.

Integers with thousands separators use Spark's ``format_string`` (exact for
integers).  Floats are formatted by one Arrow-batched pandas UDF that applies a
Python format spec: Java's formatter rounds half-up on the shortest decimal text
(72.05 -> "72.1") while the reference rounds the binary value (-> "72.0"), and its
``%g`` keeps trailing zeros.  The UDF only ever sees the handful of rows that make up
a recommendation or KPI-card table, never event-grain data.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fmt(x, spec: str) -> str | None:
    if x is None or (isinstance(x, float) and pd.isna(x)):
        x = float("nan")
    return format(float(x), spec)


@F.pandas_udf(T.StringType())
def _py_format(values: pd.Series, specs: pd.Series) -> pd.Series:
    return pd.Series([_fmt(v, s) for v, s in zip(values, specs)], dtype="object")


def py_format(c: Column | str, spec: str) -> Column:
    """Format a numeric column with a Python format spec (e.g. ``'.2%'``, ``',.0f'``)."""
    c = F.col(c) if isinstance(c, str) else c
    return _py_format(c.cast("double"), F.lit(spec))


def thousands(c: Column | str) -> Column:
    """Integer with thousands separators, e.g. 68033 -> '68,033'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.format_string("%,d", c.cast("bigint"))


def text_or_none(c: Column | str) -> Column:
    """Value as text, with null rendered as 'None' (as Python prints it)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit("None"))

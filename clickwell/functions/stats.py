"""Statistics helpers for the experiment operators.

The normal quantile is a driver-side constant (one number per alpha).  The normal
tail probability needs ``erfc``, which Spark SQL lacks, so it is an Arrow-batched
pandas UDF; it is only ever applied after aggregation, to one row per arm.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def critical_z(alpha: float) -> float:
    """Two-sided critical value: |z| > critical_z(alpha)  <=>  p < alpha."""
    return normal_quantile(1 - alpha / 2)


def two_sided_p_value(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


@F.pandas_udf(T.DoubleType())
def _two_sided_p(z: pd.Series) -> pd.Series:
    return z.abs().map(lambda v: math.erfc(v / math.sqrt(2.0)))


def two_sided_p(z: Column) -> Column:
    """p-value column for a z column; null z -> null p."""
    return F.when(z.isNotNull(), _two_sided_p(z))


def pooled_z(conv: Column, n: Column, control_conv: Column, control_n: Column) -> Column:
    """Two-proportion z statistic with pooled variance; null when the pooled variance
    is zero (no conversions at all, or all converted) or an arm is empty."""
    pooled = (conv + control_conv).cast("double") / (n + control_n).cast("double")
    nobs_fact = 1.0 / n.cast("double") + 1.0 / control_n.cast("double")
    se = F.sqrt(nobs_fact * pooled * (1 - pooled))
    diff = conv.cast("double") / n.cast("double") - control_conv.cast("double") / control_n.cast("double")
    return F.when((n > 0) & (control_n > 0), F.when(se > 0, diff / se))


def diff_ci(rate: Column, n: Column, control_rate: Column, control_n: Column,
            alpha: float) -> tuple[Column, Column]:
    """Unpooled normal CI on rate - control_rate; degenerate (diff, diff) for empty arms."""
    diff = rate - control_rate
    se = F.sqrt(rate * (1 - rate) / n.cast("double")
                + control_rate * (1 - control_rate) / control_n.cast("double"))
    margin = F.lit(critical_z(alpha)) * se
    ok = (n > 0) & (control_n > 0)
    return (F.when(ok, diff - margin).otherwise(diff), F.when(ok, diff + margin).otherwise(diff))

"""Experiment analysis (X1-X14): per-arm metrics, lift against control, pooled
two-proportion z-test, unpooled CI, incremental revenue, scenarios, arm matrix.

The only event-grain work is the per-arm aggregation (partial aggregation map-side,
so a hot arm holding a third of all recipients is pre-reduced in every task).  All
later steps run on k rows (one per arm): the control row is attached with a broadcast
of exactly one row, and the p-value UDF sees k rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ExperimentConfig
from ..functions.core import safe_ratio
from ..functions.stats import diff_ci, pooled_z, two_sided_p

MONEY = "decimal(38,2)"


def arm_metrics(stg: DataFrame, cfg: ExperimentConfig = ExperimentConfig(),
                money_type: str | None = MONEY) -> DataFrame:
    """Per arm: label, recipients, conversions, conversion rate, revenue, revenue
    per recipient.  Money is summed exactly as a decimal (inputs carry cents) unless
    ``money_type`` is None; rates are ratios of exact integer sums."""
    rev = F.col(cfg.revenue_col)
    rev = rev.cast(money_type) if money_type else rev
    # MAX of a string has no fixed-width buffer and would force a sort-based aggregate
    # over every row; the max of the per-arm label *set* runs in the object hash
    # aggregate instead (one label per arm in practice, so the set stays tiny).
    m = stg.groupBy(cfg.arm_col).agg(
        F.array_max(F.collect_set(cfg.label_col)).alias("treatment_label"),
        F.count(F.lit(1)).alias("recipients"),
        F.sum(F.col(cfg.outcome_col)).cast("bigint").alias("conversions"),
        F.sum(rev).cast("double").alias("total_revenue"),
    )
    return (m.withColumnRenamed(cfg.arm_col, "treatment_group")
            .withColumns({"conversion_rate": safe_ratio("conversions", "recipients"),
                          "revenue_per_customer": safe_ratio("total_revenue", "recipients")})
            .select("treatment_group", "treatment_label", "recipients", "conversions",
                    "conversion_rate", "total_revenue", "revenue_per_customer"))


def arm_rank(cfg: ExperimentConfig = ExperimentConfig()):
    """Output order: listed arms first in config order, then the rest by name."""
    order = F.array(*[F.lit(a) for a in cfg.arm_order])
    pos = F.array_position(order, F.col("treatment_group"))
    return F.when(pos > 0, pos).otherwise(F.lit(len(cfg.arm_order) + 1)).cast("int")


def with_control(arms: DataFrame, cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """Attach the control arm's metrics to every arm.  The arm table has one row
    per arm, so a window over the whole table (k rows in one task) carries the control
    values without consuming the aggregate twice (which would re-scan the input under
    adaptive execution).  A missing control arm fails the job."""
    whole = Window.partitionBy()
    is_control = F.col("treatment_group") == cfg.control

    def control(c):
        return F.max(F.when(is_control, F.col(c))).over(whole)

    out = arms.withColumns({"_c_n": control("recipients"), "_c_conv": control("conversions"),
                            "_c_rate": control("conversion_rate"),
                            "_c_rpc": control("revenue_per_customer")})
    return out.withColumn(
        "_c_n", F.when(F.col("_c_n").isNull(),
                       F.raise_error(F.lit(f"Missing required control group: {cfg.control}")))
        .otherwise(F.col("_c_n")))


def ab_results(stg: DataFrame, cfg: ExperimentConfig = ExperimentConfig(),
               with_p_value: bool = True, with_z: bool = False) -> DataFrame:
    """The experiment results mart (15 columns; ``with_z`` adds ``z_score``)."""
    a = with_control(arm_metrics(stg, cfg), cfg)
    is_control = F.col("treatment_group") == cfg.control
    n, conv, rate = F.col("recipients"), F.col("conversions"), F.col("conversion_rate")
    c_n, c_conv, c_rate = F.col("_c_n"), F.col("_c_conv"), F.col("_c_rate")
    lift = rate - c_rate
    z = pooled_z(conv, n, c_conv, c_n)
    lo, hi = diff_ci(rate, n, c_rate, c_n, cfg.alpha)
    out = a.withColumns({
        "control_conversion_rate": c_rate,
        "absolute_lift": F.when(is_control, 0.0).otherwise(lift),
        "relative_lift_pct": F.when(is_control | (c_rate == 0), 0.0)
                              .otherwise(lift / c_rate * 100.0),
        "incremental_revenue": F.when(is_control, 0.0)
                                .otherwise((F.col("revenue_per_customer") - F.col("_c_rpc")) * n),
        "z_score": F.when(is_control, F.lit(None).cast("double")).otherwise(z),
        "ci_lower": F.when(is_control, 0.0).otherwise(lo),
        "ci_upper": F.when(is_control, 0.0).otherwise(hi),
    })
    empty = (n == 0) | (c_n == 0)
    p = F.when(is_control, F.lit(None).cast("double")).when(empty, F.lit(1.0)) \
        .otherwise(two_sided_p(F.col("z_score")))
    if with_p_value:
        out = out.withColumn("p_value", p).withColumn(
            "statistically_significant", F.coalesce(F.col("p_value") < cfg.alpha, F.lit(False)))
    else:
        # |z| > z_(1-alpha/2) is the same decision as p < alpha, without the UDF.
        from ..functions.stats import critical_z
        out = out.withColumn("statistically_significant", F.coalesce(
            ~is_control & (F.abs(F.col("z_score")) > critical_z(cfg.alpha)), F.lit(False)))
    cols = ["treatment_group", "treatment_label", "recipients", "conversions", "conversion_rate",
            "total_revenue", "revenue_per_customer", "control_conversion_rate", "absolute_lift",
            "relative_lift_pct", "incremental_revenue"]
    cols += ["p_value"] if with_p_value else []
    cols += ["ci_lower", "ci_upper", "statistically_significant"]
    cols += ["z_score"] if with_z else []
    return out.select(*cols)


def ab_summary(results: DataFrame, staging_rows: DataFrame,
               cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """Mart rows, total recipients, significant treatment arms (comma list, by
    name) and the reconciliation flag (recipients == staging rows).  ``staging_rows``
    is a one-row frame with column ``staging_row_count``."""
    significant = F.col("statistically_significant") & (F.col("treatment_group") != cfg.control)
    s = results.agg(
        F.count(F.lit(1)).alias("mart_row_count"),
        F.coalesce(F.sum("recipients"), F.lit(0)).cast("bigint").alias("total_recipients"),
        F.coalesce(F.sum("conversions"), F.lit(0)).cast("bigint").alias("total_conversions"),
        F.concat_ws(",", F.array_sort(F.collect_list(
            F.when(significant, F.col("treatment_group"))))).alias("significant_treatments"),
    )
    return (s.crossJoin(F.broadcast(staging_rows))
            .withColumns({
                "significance_alpha": F.lit(float(cfg.alpha)),
                "overall_conversion_rate": F.round(safe_ratio("total_conversions",
                                                              "total_recipients"), 6),
                "success": (F.col("mart_row_count") > 0)
                           & (F.col("total_recipients") == F.col("staging_row_count"))}))


# Digits per column in the experiment summary's rounded rows (fixed values).
SUMMARY_DIGITS = {"conversion_rate": 6, "total_revenue": 2, "revenue_per_customer": 6,
                  "control_conversion_rate": 6, "absolute_lift": 6, "relative_lift_pct": 4,
                  "incremental_revenue": 2, "p_value": 6, "ci_lower": 6, "ci_upper": 6}


def ab_rounded(results: DataFrame) -> DataFrame:
    """X12 rows as reported in the run summary (rates 6 dp, money 2 dp, relative lift
    4 dp); the mart itself keeps full precision."""
    return results.withColumns({c: F.round(c, d) for c, d in SUMMARY_DIGITS.items()
                                if c in results.columns})


def scenario_lift(results: DataFrame, scenarios: DataFrame | None = None,
                  cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """What-if lift for hypothetical per-arm rates (``treatment_group``,
    ``scenario_rate``); defaults to the observed rates.  Relative lift here is a
    fraction and is null when the control scenario rate is 0."""
    if scenarios is None:
        scenarios = results.select("treatment_group",
                                   F.col("conversion_rate").alias("scenario_rate"))
    is_control = F.col("treatment_group") == cfg.control
    s = scenarios.withColumn("_c", F.max(F.when(is_control, F.col("scenario_rate")))
                             .over(Window.partitionBy()))
    return s.select(
        "treatment_group", "scenario_rate",
        F.when(is_control, 0.0).otherwise(F.col("scenario_rate") - F.col("_c"))
        .alias("scenario_absolute_lift"),
        F.when(is_control, 0.0).when(F.col("_c") == 0, F.lit(None).cast("double"))
        .otherwise((F.col("scenario_rate") - F.col("_c")) / F.col("_c"))
        .alias("scenario_relative_lift"),
    )


# --- fixed values that must equal the reference: arm-matrix row labels ---------
MATRIX_METRICS = (
    ("Recipients", "recipients"),
    ("Conversions", "conversions"),
    ("Conversion rate", "conversion_rate"),
    ("Absolute lift vs control", "absolute_lift"),
    ("Relative lift %", "relative_lift_pct"),
    ("Incremental revenue", "incremental_revenue"),
    ("p-value vs control", "p_value"),
)


def arm_matrix(results: DataFrame, cfg: ExperimentConfig = ExperimentConfig(),
               metrics: tuple[tuple[str, str], ...] = MATRIX_METRICS) -> DataFrame:
    """Metrics as rows, arms as columns: the configured arms first, in their order,
    then any others that the results hold, by name (k names, read from the mart)."""
    found = {r[0] for r in results.select("treatment_group").distinct().collect()}
    arms = list(cfg.arm_order) + sorted(found - set(cfg.arm_order) - {None})
    long = results.select(
        "treatment_group",
        F.explode(F.array(*[F.struct(F.lit(i).alias("metric_order"), F.lit(label).alias("metric"),
                                     F.col(c).cast("double").alias("value"))
                            for i, (label, c) in enumerate(metrics)])).alias("m"))
    long = long.select("treatment_group", "m.metric_order", "m.metric", "m.value")
    return long.groupBy("metric_order", "metric").pivot("treatment_group", arms).agg(F.first("value"))


def ordered_arms(results: DataFrame, cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """The results with ``arm_order`` (1-based rank in output order)."""
    return results.withColumn("arm_order", F.row_number().over(Window.orderBy(arm_rank(cfg), "treatment_group")).cast("int"))

"""Configuration: column names, arms and thresholds.  Operators take these as
arguments so they run on any impression log or any N-arm experiment."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values that must equal the reference ----------------------------------
SEGMENT_MAP = {"No E-Mail": "control", "Mens E-Mail": "mens_email",
               "Womens E-Mail": "womens_email"}
TREATMENT_LABELS = {"control": "Control (No E-Mail)", "mens_email": "Mens E-Mail",
                    "womens_email": "Womens E-Mail"}
ZIP_CODE_MAP = {"Surburban": "Suburban", "Suburban": "Suburban", "Urban": "Urban",
                "Rural": "Rural"}
TREATMENT_ORDER = ("control", "mens_email", "womens_email")
CONTROL_GROUP = "control"
SIGNIFICANCE_ALPHA = 0.05
DEFAULT_MIN_IMPRESSIONS = 1000
RANKING_LIMIT = 5
CTR_SCALE_MULTIPLIER = 1.15
CTR_PAUSE_MULTIPLIER = 0.75
FORECAST_MAPE_RETEST_THRESHOLD = 100.0
MOVING_AVERAGE_WINDOW = 3
MIN_SERIES_LENGTH = 2
DEFAULT_HOLDOUT_HOURS = 1
PRIMARY_MODEL_NAME = "moving_average_3"
NAIVE_MODEL_NAME = "naive_last_hour"
VALIDATION_TOLERANCE = 0.0001
SEGMENT_DIMS = ("device_type", "app_category", "site_category", "banner_pos")
AD_NUMERIC_COLUMNS = ("banner_pos", "device_conn_type", "c14", "c15", "c16", "c17", "c18",
                      "c19", "c20", "c21")
ACTIONS = ("Scale", "Pause", "Retest")
# ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class ExperimentConfig:
    arm_col: str = "treatment_group"
    label_col: str = "treatment_label"
    outcome_col: str = "converted"
    revenue_col: str = "revenue"
    control: str = CONTROL_GROUP
    # Output order of arms; arms not listed sort after the listed ones, by name.
    arm_order: tuple[str, ...] = TREATMENT_ORDER
    alpha: float = SIGNIFICANCE_ALPHA


@dataclass(frozen=True)
class RankingConfig:
    dims: tuple[str, ...] = SEGMENT_DIMS
    min_impressions: int = DEFAULT_MIN_IMPRESSIONS
    limit: int = RANKING_LIMIT


@dataclass(frozen=True)
class RuleConfig:
    scale_multiplier: float = CTR_SCALE_MULTIPLIER
    pause_multiplier: float = CTR_PAUSE_MULTIPLIER
    mape_retest_threshold: float = FORECAST_MAPE_RETEST_THRESHOLD
    rule_candidates: int = 3

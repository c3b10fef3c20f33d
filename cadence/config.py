"""Project configuration: column lists, thresholds and model profiles.

FIXED VALUES. The names, lists and numbers below must equal the reference
project's for equal results; they are stated here as plain data, together.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

# --- fixed values: data contract -------------------------------------------
SEED = 42
TARGET = "count"
DATETIME = "datetime"
LEAKAGE_COLUMNS = ("casual", "registered")
SUB_TARGETS = ("casual", "registered")
N_SPLITS = 5
DEFAULT_GAP = 0
HOLDOUT_DAY_THRESHOLD = 16          # train days 1-15, holdout days 16-19
UNLABELED_DAY_THRESHOLD = 20        # days 20+ carry no label

# --- fixed values: features -------------------------------------------------
TIME_FEATURES = ("hour", "dayofweek", "month", "year", "is_weekend")
CYCLIC_FEATURES = ("hour_sin", "hour_cos", "month_sin", "month_cos", "hour_sin2", "hour_cos2")
INTERACTION_FEATURES = ("hour_sin_workday", "hour_cos_workday")
ADDED_FEATURES = TIME_FEATURES + CYCLIC_FEATURES + INTERACTION_FEATURES

CANDIDATE_NUMERIC = ("feels_like_gap", "temp_humidity_interaction", "comfort_index")
CANDIDATE_PASSTHROUGH = ("is_morning_peak", "is_evening_peak", "is_rush_hour", "is_2012", "bad_weather")
CANDIDATE_FEATURES = CANDIDATE_NUMERIC + CANDIDATE_PASSTHROUGH
MORNING_PEAK_HOURS = (7, 8, 9)
EVENING_PEAK_HOURS = (16, 17, 18, 19)
TREND_YEAR = 2012
BAD_WEATHER_LEVEL = 3

# Raw columns of the hourly demand table (labeled) and the unlabeled subset.
RAW_COLUMNS = ("datetime", "season", "holiday", "workingday", "weather", "temp", "atemp",
               "humidity", "windspeed", "casual", "registered", "count")
UNLABELED_COLUMNS = RAW_COLUMNS[:9]

# --- fixed values: linear model routing ------------------------------------
LINEAR_NUMERIC = ("temp", "atemp", "humidity", "windspeed")
LINEAR_PASSTHROUGH = ("holiday", "workingday", "is_weekend", "hour_sin", "hour_cos", "month_sin",
                      "month_cos", "hour_sin2", "hour_cos2", "hour_sin_workday", "hour_cos_workday")
LINEAR_ONE_HOT = ("season", "weather")

# --- fixed values: experiments ------------------------------------------------
FEATURE_GROUPS = {
    "peaks": ("is_morning_peak", "is_evening_peak", "is_rush_hour"),
    "environmental": ("feels_like_gap", "temp_humidity_interaction", "bad_weather"),
    "year_trend": ("is_2012",),
    "all": CANDIDATE_FEATURES,
}
ENV_ARMS = ("baseline", "comfort", "recalib", "all")
N_QUANTILES = 5
PERMUTATION_REPEATS = 10
PROMOTION_BOOSTED_GAIN = 0.01
PROMOTION_RIDGE_GAIN = 0.03
PROMOTION_TREE_TOLERANCE = 0.005
NO_REGRESSION_GAIN = 0.01
SEARCH_DRAWS = {"xgboost": 40, "gradient_boosting": 30}
SEARCH_SPACE = {
    "xgboost": {
        "n_estimators": [200, 400, 600, 800],
        "max_depth": [3, 4, 5, 6, 8],
        "learning_rate": [0.02, 0.05, 0.1],
        "subsample": [0.7, 0.8, 0.9, 1.0],
        "colsample_bytree": [0.7, 0.8, 0.9, 1.0],
        "min_child_weight": [1, 3, 5],
        "reg_lambda": [0.5, 1.0, 2.0, 5.0],
    },
    "gradient_boosting": {
        "n_estimators": [200, 300, 500],
        "learning_rate": [0.02, 0.05, 0.1],
        "max_depth": [2, 3, 4],
        "subsample": [0.7, 0.8, 0.9, 1.0],
        "min_samples_leaf": [1, 3, 5],
        "max_features": ["sqrt", 0.8, None],
    },
}

# Published model hyperparameters.
PUBLISHED_PARAMS: dict[str, dict[str, Any]] = {
    "ridge": {"alpha": 1.0},
    "random_forest": {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 2},
    "gradient_boosting": {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 3, "subsample": 0.9},
    "xgboost": {"n_estimators": 400, "learning_rate": 0.05, "max_depth": 5, "subsample": 0.9,
                "colsample_bytree": 0.9},
}

MODEL_NAMES = ("mean_baseline", "hourly_mean_baseline", "ridge", "random_forest",
               "gradient_boosting", "xgboost")


@dataclass(frozen=True)
class Config:
    """What the reference keeps in YAML: target, datetime column, folds, leakage list."""

    target: str = TARGET
    datetime_col: str = DATETIME
    seed: int = SEED
    n_splits: int = N_SPLITS
    gap: int = DEFAULT_GAP
    drop_columns: tuple[str, ...] = LEAKAGE_COLUMNS
    order_cols: tuple[str, ...] = (DATETIME, "row_id")
    params: dict[str, dict[str, Any]] = field(default_factory=lambda: dict(PUBLISHED_PARAMS))

    def with_(self, **kw) -> "Config":
        values = {**self.__dict__, **kw}
        return Config(**values)

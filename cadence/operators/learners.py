"""Learners on a log1p target with a non-negative inverse.

Each estimator fits on a training DataFrame and predicts on another; the label is
``log1p(label)`` and predictions come back through ``from_log1p`` (``pred``) with
the log-space value kept as ``log_pred`` for bias correction. The ridge solves the normal
equations of one scan's Gram matrix; trees are those of ``batchfit``. Searches and sweeps fit many at
once (``batchfit.scores``, ``ridge.scores``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.config import (MODEL_NAMES, ADDED_FEATURES, LINEAR_NUMERIC, LINEAR_ONE_HOT, LINEAR_PASSTHROUGH, SEED)
from cadence.functions.features import from_log1p
from cadence.operators import batchfit
from cadence.operators.baselines import Estimator, Fitted
from cadence.operators.fitted import OneHotLevels, PopulationScaler
from cadence.operators.trees import Settings

RAW_FEATURES = ("season", "holiday", "workingday", "weather", "temp", "atemp", "humidity", "windspeed")
TREE_FEATURES = RAW_FEATURES + ADDED_FEATURES


class LinearSpec:
    """M5: route columns - scale, pass through, one-hot; everything else dropped
    (raw hour, month, dayofweek and year never reach the linear model)."""

    def __init__(self, numeric=LINEAR_NUMERIC, passthrough=LINEAR_PASSTHROUGH, one_hot=LINEAR_ONE_HOT,
                 extra_numeric: Sequence[str] = (), extra_passthrough: Sequence[str] = ()):
        self.numeric = list(numeric) + list(extra_numeric)
        self.passthrough = list(passthrough) + list(extra_passthrough)
        self.one_hot = list(one_hot)

    def fit(self, df: DataFrame, extra_aggs=()) -> "FittedSpec":
        """Two passes: scaler moments (plus any ``extra_aggs``) and one-hot levels."""
        return FittedSpec(self, PopulationScaler(self.numeric, "__s").fit(df, extra_aggs),
                          OneHotLevels(self.one_hot).fit(df))


class FittedSpec:
    def __init__(self, spec: LinearSpec, scaler: PopulationScaler, onehot: OneHotLevels):
        self.spec, self.scaler, self.onehot = spec, scaler, onehot

    def names(self) -> list[str]:
        return [f"{c}__s" for c in self.spec.numeric] + self.spec.passthrough + self.onehot.output_columns()

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.onehot.transform(self.scaler.transform(df))
        out = out.withColumns({c: F.col(c).cast("double") for c in self.spec.passthrough})
        return VectorAssembler(inputCols=self.names(), outputCol="features", handleInvalid="keep").transform(out)


class LinearFitted(Fitted):
    """An intercept, a weight per column, and a weight per level of categorical columns
    (another level, or none, weighs nothing). Predictions are one projection; a row that
    misses a number has none."""

    log_space = True

    def __init__(self, intercept: float, weights: dict[str, float], levels: dict[str, dict[float, float]]):
        self.intercept, self.weights, self.levels = intercept, dict(weights), {c: dict(v) for c, v in levels.items()}
        self.inputs = (*self.weights, *self.levels)

    def predict_log(self, df: DataFrame) -> DataFrame:
        out = F.lit(self.intercept)
        for c, w in self.weights.items():
            out = out + F.col(c).cast("double") * F.lit(w)
        for c, levels in self.levels.items():
            weight = F.lit(0.0)
            for v, w in levels.items():
                weight = F.when(F.col(c) == F.lit(v), F.lit(w)).otherwise(weight)
            out = out + weight
        return df.withColumn("log_pred", out)

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return self.predict_log(df).withColumn(out, from_log1p(F.col("log_pred")))


class RidgeLog(Estimator):
    """M6/M7/M8: L2-penalised least squares on log1p(y), intercept unpenalised, scaled
    columns by their population spread: ``ridge.GramTable`` with all rows as one segment."""

    name = "ridge"

    def __init__(self, alpha: float = 1.0, spec: LinearSpec | None = None):
        self.alpha = alpha
        self.spec = spec or LinearSpec()

    def fit(self, df: DataFrame, label: str) -> Fitted:
        from cadence.operators.ridge import GramTable, RidgeFit
        fit = RidgeFit(self.spec, self.alpha)
        return GramTable(df, [fit], label, [batchfit.View(F.lit(1), F.lit(0))], F.lit(0)).fitted(fit)


class TreesFitted(Fitted):
    """A fitted boosted ensemble; its trees, bounded by its rounds and depth, are broadcast
    to the tasks that predict."""

    log_space = True

    def __init__(self, model: batchfit.Ensemble):
        self.model = model
        self.inputs = tuple(model.columns)
        self._shared = None

    def predict_log(self, df: DataFrame) -> DataFrame:
        if self._shared is None:
            self._shared = df.sparkSession.sparkContext.broadcast(self.model)
        shared = self._shared

        @F.pandas_udf("double")
        def score(*cols: pd.Series) -> pd.Series:
            return pd.Series(shared.value.log_score(np.stack([c.to_numpy(np.float64) for c in cols], axis=1)))
        return df.withColumn("log_pred", score(*[F.col(c).cast("double") for c in self.inputs]))

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return self.predict_log(df).withColumn(out, from_log1p(F.col("log_pred")))


class ForestFitted(Fitted):
    """A fitted forest whose trees stay in their table: rows go to batches of trees."""

    log_space = True

    def __init__(self, model: batchfit.Forest):
        self.model = model
        self.inputs = tuple(model.columns)

    def predict_log(self, df: DataFrame) -> DataFrame:
        return batchfit.forest_scores(self.model, df, "log_pred")

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return self.predict_log(df).withColumn(out, from_log1p(F.col("log_pred")))


class _TreeLog(Estimator):
    """``honoured`` maps the published parameter names to those of ``Settings``;
    ``defaults`` are the settings where a parameter is not given."""

    honoured: dict[str, str] = {}
    defaults: dict = {}

    def __init__(self, features: Sequence[str] = TREE_FEATURES, **params):
        unknown = sorted(set(params) - set(self.honoured))
        if unknown:
            raise ValueError(f"{self.name} has no effect for {unknown}; it takes {sorted(self.honoured)}")
        self.features = list(features)
        self.params = params

    def settings(self) -> Settings:
        own = {self.honoured[k]: v for k, v in self.params.items()}
        return Settings(**{"seed": SEED, **self.defaults, **own})

    def fit(self, df: DataFrame, label: str) -> Fitted:
        # a row's draws follow its key, so they don't depend on the partitions
        key = F.xxhash64("row_id") if "row_id" in df.columns else F.xxhash64(*self.features, label)
        table = batchfit.binned(df, self.features, label, [batchfit.View(F.lit(1), F.lit(0))], key)
        one = batchfit.Fit(tuple(self.features), self.settings())
        if one.settings.bootstrap:
            return ForestFitted(batchfit.forest(table, one, batchfit.TASK_ROWS))
        return TreesFitted(batchfit.ensemble(table, one))


class ForestLog(_TreeLog):
    """M9: random forest of trees without a depth limit, every feature considered at each
    split; each tree's rows are drawn with replacement."""

    name = "random_forest"
    honoured = {"n_estimators": "rounds", "max_depth": "max_depth", "min_samples_leaf": "min_rows"}
    defaults = {"rounds": 100, "bootstrap": True}


class BoostLog(_TreeLog):
    """Gradient-boosted trees from the mean, with row subsampling; columns may be
    drawn per node."""

    name = "gradient_boosting"
    honoured = {"n_estimators": "rounds", "learning_rate": "learning_rate", "max_depth": "max_depth", "subsample": "row_share",
                "min_samples_leaf": "min_rows", "max_features": "node_columns"}
    defaults = {"rounds": 100, "learning_rate": 0.1, "max_depth": 3}


class ColumnBoostLog(_TreeLog):
    """Second-order boosted trees with an L2 penalty on leaves, a floor for a
    child's sum of Hessians, and rows and columns drawn per tree."""

    name = "xgboost"
    honoured = {"n_estimators": "rounds", "learning_rate": "learning_rate", "max_depth": "max_depth", "subsample": "row_share",
                "colsample_bytree": "tree_columns", "min_child_weight": "min_weight", "reg_lambda": "leaf_penalty"}
    defaults = {"rounds": 100, "learning_rate": 0.3, "max_depth": 6, "min_weight": 1.0, "leaf_penalty": 1.0}


def get_model(name: str, params: dict | None = None, extra_numeric=(), extra_passthrough=(), extra_tree=()):
    """Estimator by name; ``extra_*`` route candidate columns."""
    from cadence.operators.baselines import HourlyMeanBaseline, MeanBaseline
    p = dict(params or {})
    if name == "mean_baseline":
        return MeanBaseline()
    if name == "hourly_mean_baseline":
        return HourlyMeanBaseline()
    if name == "ridge":
        return RidgeLog(p.get("alpha", 1.0), LinearSpec(extra_numeric=extra_numeric, extra_passthrough=extra_passthrough))
    feats = TREE_FEATURES + tuple(extra_tree)
    if name == "random_forest":
        return ForestLog(feats, **p)
    if name == "gradient_boosting":
        return BoostLog(feats, **p)
    if name == "xgboost":
        return ColumnBoostLog(feats, **p)
    raise ValueError(f"no model is called {name!r}; there are {', '.join(MODEL_NAMES)}")

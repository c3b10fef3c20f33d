"""Transforms fitted on training rows only.

``fit`` reads a few scalars from one aggregation (a median, eight moments, a
short level list); ``transform`` is a projection with those values as literals, so
a held-out row can never move a fitted value.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.features import fill_zero, linear2
from cadence.operators.order import exact_quantiles

LEVEL_LIMIT = 10_000   # a one-hot column with more levels than this is not categorical


def positive_only(df: DataFrame, col: str) -> DataFrame:
    """The rows whose value is above zero (NULL and NaN are not)."""
    return df.filter((F.col(col) > 0) & ~F.isnan(F.col(col).cast("double")))


class WindspeedZeroImputer:
    """M17 (E23 + B23): zeros are the sensor floor; fill them with the median of
    the strictly positive training values (0.0 when there are none)."""

    def __init__(self, col: str = "windspeed"):
        self.col = col
        self.fill_value_: float | None = None

    def fit(self, df: DataFrame) -> "WindspeedZeroImputer":
        row = exact_quantiles(positive_only(df, self.col), self.col, [0.5]).first()
        self.fill_value_ = float(row["q"]) if row is not None and row["q"] is not None else 0.0
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.col, fill_zero(F.col(self.col), self.fill_value_))


def least_squares_2(df: DataFrame, y: str, x1: str, x2: str) -> tuple[float, float, float]:
    """Intercept and two slopes of y ~ x1 + x2, from one aggregation of means
    and population (co)variances (the normal equations of the centered problem)."""
    m = df.agg(F.avg(x1).alias("m1"), F.avg(x2).alias("m2"), F.avg(y).alias("my"),
               F.var_pop(x1).alias("v11"), F.var_pop(x2).alias("v22"), F.covar_pop(x1, x2).alias("v12"),
               F.covar_pop(x1, y).alias("v1y"), F.covar_pop(x2, y).alias("v2y")).first()
    a = np.array([[m["v11"], m["v12"]], [m["v12"], m["v22"]]], dtype=float)
    b = np.array([m["v1y"], m["v2y"]], dtype=float)
    coef = np.linalg.lstsq(a, b, rcond=None)[0]   # minimum-norm when collinear
    intercept = m["my"] - coef[0] * m["m1"] - coef[1] * m["m2"]
    return float(intercept), float(coef[0]), float(coef[1])


class AtempRecalibrator:
    """M17 (E24 + B24): replace ``atemp`` by its least-squares fit on temp and humidity."""

    FEATURES = ("temp", "humidity")

    def __init__(self, col: str = "atemp"):
        self.col = col
        self.coef_: tuple[float, float, float] | None = None

    def fit(self, df: DataFrame) -> "AtempRecalibrator":
        self.coef_ = least_squares_2(df, self.col, *self.FEATURES)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        a, b, c = self.coef_
        return df.withColumn(self.col, linear2(a, b, c, F.col(self.FEATURES[0]), F.col(self.FEATURES[1])))


class PopulationScaler:
    """M3: (x - mean) / population std, fitted per training frame; zero spread
    scales by 1 (Spark ML's StandardScaler would use the sample std)."""

    def __init__(self, cols: Sequence[str], suffix: str = ""):
        self.cols = list(cols)
        self.suffix = suffix
        self.stats_: dict[str, tuple[float, float]] = {}

    def aggregates(self) -> list:
        aggs = []
        for k, c in enumerate(self.cols):
            aggs += [F.avg(c).alias(f"__m{k}"), F.stddev_pop(c).alias(f"__s{k}")]
        return aggs

    def set_from(self, row) -> "PopulationScaler":
        for k, c in enumerate(self.cols):
            s = row[f"__s{k}"]
            self.stats_[c] = (float(row[f"__m{k}"]), float(s) if s else 1.0)
        return self

    def fit(self, df: DataFrame, extra_aggs=()) -> "PopulationScaler":
        """One aggregation; ``extra_aggs`` ride along (their values stay on ``last_row_``)."""
        self.last_row_ = df.agg(*self.aggregates(), *extra_aggs).first()
        return self.set_from(self.last_row_)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}{self.suffix}": (F.col(c) - F.lit(m)) / F.lit(s)
                               for c, (m, s) in self.stats_.items()})


class OneHotLevels:
    """M4: learn the level list of each column on training rows and emit one 0/1
    column per level; a level unseen in training, or none, is all zeros."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)
        self.levels_: dict[str, list] = {}

    def fit(self, df: DataFrame) -> "OneHotLevels":
        """One distinct pass over (column, level) pairs for all columns; at most
        LEVEL_LIMIT + 1 rows per column ever reach the driver."""
        if not self.cols:
            return self
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("v"))
                                               for k, c in enumerate(self.cols)])).alias("p"))
        lv = pairs.select("p.k", "p.v").filter(F.col("v").isNotNull()).distinct()
        cap = len(self.cols) * (LEVEL_LIMIT + 1)
        rows = lv.limit(cap).collect()
        if len(rows) >= cap:
            raise ValueError(f"{self.cols} have more than {LEVEL_LIMIT} levels; one-hot is for categorical columns")
        for k, c in enumerate(self.cols):
            vals = sorted(r["v"] for r in rows if r["k"] == k)
            if len(vals) > LEVEL_LIMIT:
                raise ValueError(f"{c} has more than {LEVEL_LIMIT} levels; one-hot is for categorical columns")
            self.levels_[c] = [int(v) if float(v).is_integer() else v for v in vals]
        return self

    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c in self.cols for v in self.levels_[c]]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0))
                               for c in self.cols for v in self.levels_[c]})

"""Baseline models (M1, M2) and the fit/predict protocol shared with learners.

A fitted model keeps only small state: a scalar mean, or a table with one row per
hour (at most 24 rows, so broadcasting it has a proven bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators.order import join_small


class Fitted:
    """A fitted model: ``predict`` adds a count-scale ``pred`` column."""

    log_space = False
    #: Columns that ``predict`` reads; None: not known, so any.
    inputs: tuple[str, ...] | None = None

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:  # pragma: no cover
        raise NotImplementedError


class Estimator:
    name = "estimator"

    def fit(self, df: DataFrame, label: str) -> Fitted:  # pragma: no cover
        raise NotImplementedError


class _MeanFitted(Fitted):
    inputs = ()

    def __init__(self, mean: float):
        self.mean_ = mean

    def predict(self, df, out="pred"):
        return df.withColumn(out, F.lit(self.mean_).cast("double"))


class MeanBaseline(Estimator):
    """M1: the training mean of the label for every row."""

    name = "mean_baseline"

    def fit(self, df, label):
        mean = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
        return _MeanFitted(float(mean))


class _HourlyFitted(Fitted):
    inputs = ("hour",)

    def __init__(self, hour_means: DataFrame, global_mean: float):
        self.hour_means_ = hour_means
        self.global_mean_ = global_mean

    def predict(self, df, out="pred"):
        if "hour" not in df.columns:
            raise ValueError("no column 'hour': the hourly mean needs the calendar features")
        means = self.hour_means_.withColumnRenamed("hour", "_h")
        joined = join_small(df.withColumn("_h", F.col("hour").cast("int")), means, "_h", "left", rows_bound=24)
        return joined.withColumn(out, F.coalesce(F.col("_hour_mean"), F.lit(self.global_mean_))).drop(
            "_h", "_hour_mean")


class HourlyMeanBaseline(Estimator):
    """M2: per-hour mean of the label; an hour unseen in training gets the global mean."""

    name = "hourly_mean_baseline"

    def fit(self, df, label):
        if "hour" not in df.columns:
            raise ValueError("no column 'hour': the hourly mean needs the calendar features")
        y = F.col(label).cast("double")
        # One scan: per-hour sums and counts (<= 24 rows); the global mean comes
        # from that small table, not from a second pass over the rows.
        stats = df.groupBy(F.col("hour").cast("int").alias("hour")).agg(
            F.sum(y).alias("_s"), F.count(y).alias("_c"))
        stats = df.sparkSession.createDataFrame(stats.collect(), stats.schema)   # a row an hour of the day
        global_mean = stats.agg(F.sum("_s") / F.sum("_c")).first()[0]
        hour_means = stats.select("hour", (F.col("_s") / F.col("_c")).alias("_hour_mean"))
        return _HourlyFitted(hour_means, float(global_mean))


def hour_mean_table(df: DataFrame, label: str) -> DataFrame:
    """E5: mean label per hour."""
    return df.groupBy(F.col("hour").cast("int").alias("hour")).agg(
        F.avg(F.col(label).cast("double")).alias("mean"), F.count(F.lit(1)).alias("n"))

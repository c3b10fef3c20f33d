"""Hand-computed metric values (the reference's own unit fixtures)."""
import math

import pytest
from pyspark.sql import functions as F

from cadence.functions import metrics as mx


def _one(spark, ys, ps, fn):
    df = spark.createDataFrame(list(zip(map(float, ys), map(float, ps))), "y double, p double")
    return df.agg(fn(F.col("y"), F.col("p")).alias("v")).first()["v"]


def test_rmse_hand_value(spark):
    assert _one(spark, [0, 0, 0], [2, 0, 0], mx.rmse) == pytest.approx(math.sqrt(4 / 3))


def test_mae(spark):
    assert _one(spark, [1, 2, 3], [2, 2, 5], mx.mae) == pytest.approx(1.0)


def test_r2_constant_target(spark):
    assert _one(spark, [5, 5, 5], [5, 5, 5], mx.r2) == 1.0
    assert _one(spark, [5, 5, 5], [5, 6, 4], mx.r2) == 0.0


def test_r2_mean_predictor_is_zero(spark):
    assert _one(spark, [1, 2, 3, 4], [2.5] * 4, mx.r2) == pytest.approx(0.0)


def test_rmsle_clips_negative_prediction(spark):
    assert _one(spark, [0], [-5], mx.rmsle) == _one(spark, [0], [0], mx.rmsle)


def test_report_has_all_four_and_groups(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, 2.0), (2, 3.0, 1.0)], "k int, y double, p double")
    rows = {r["k"]: r for r in mx.report(df, "y", "p", by=["k"]).collect()}
    assert set(rows[1].asDict()) == {"k", "rmsle", "rmse", "mae", "r2", "n"}
    assert rows[1]["n"] == 2 and rows[2]["mae"] == pytest.approx(2.0)


def test_fold_summary_population_std(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 0.5), (2, 3.0, 1.0, 1.0, 0.5)], "fold int, rmsle double, rmse double, mae double, r2 double")
    row = mx.fold_summary(df).first()
    assert row["mean_rmsle"] == pytest.approx(2.0) and row["std_rmsle"] == pytest.approx(1.0)

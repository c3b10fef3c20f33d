"""Target transforms, smearing and fit-on-train-only transforms."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.functions import features as fx
from cadence.operators.correct import smearing_factor
from cadence.operators.fitted import AtempRecalibrator, WindspeedZeroImputer


def test_log1p_round_trip(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 5.0, 100.0, 977.0)], "y double")
    out = df.select("y", fx.from_log1p(fx.to_log1p(F.col("y"))).alias("b")).collect()
    assert all(abs(r["y"] - r["b"]) < 1e-9 for r in out)


def test_inverse_clips_at_zero(spark):
    df = spark.createDataFrame([(v,) for v in (-5.0, -0.01, 0.0, 0.5, 2.0)], "z double")
    out = [r["v"] for r in df.select(fx.from_log1p(F.col("z")).alias("v")).collect()]
    assert all(v >= 0 for v in out) and out[0] == 0.0 and out[1] == 0.0


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "z double")
    assert df.select(fx.clip0(F.col("z")).alias("v")).first()["v"] is None


def test_smearing_factor_is_mean_exp(spark):
    e = [-0.2, 0.0, 0.1, 0.3]
    df = spark.createDataFrame([(math.expm1(0.0), -x) for x in e], "y double, log_pred double")
    assert smearing_factor(df, "y").first()["theta"] == pytest.approx(np.mean(np.exp(e)))


def test_smearing_below_one_not_clamped(spark):
    e = [-0.5, -0.3, -0.4]
    df = spark.createDataFrame([(0.0, -x) for x in e], "y double, log_pred double")
    theta = smearing_factor(df, "y").first()["theta"]
    assert theta < 1 and theta == pytest.approx(np.mean(np.exp(e)))


def test_apply_smearing(spark):
    lp = [math.log(2.0), math.log(5.0), math.log(0.1)]
    df = spark.createDataFrame([(v,) for v in lp], "lp double")
    out = [r["v"] for r in df.select(fx.apply_smearing(F.col("lp"), 1.2).alias("v")).collect()]
    assert out == pytest.approx([1.4, 5.0, 0.0])


def test_windspeed_fill(spark):
    fit = spark.createDataFrame([(v,) for v in (0.0, 10.0, 20.0, 30.0)], "windspeed double")
    hold = spark.createDataFrame([(0.0,), (5.0,)], "windspeed double")
    imp = WindspeedZeroImputer().fit(fit)
    assert imp.fill_value_ == 20.0
    assert [r["windspeed"] for r in imp.transform(hold).collect()] == [20.0, 5.0]


def test_fill_ignores_held_out_row(spark):
    fit = spark.createDataFrame([(v,) for v in (0.0, 10.0, 20.0, 30.0)], "windspeed double")
    assert WindspeedZeroImputer().fit(fit).fill_value_ == 20.0   # a held-out 1000 never enters fit


def test_fill_with_no_positive_values(spark):
    fit = spark.createDataFrame([(0.0,), (0.0,)], "windspeed double")
    assert WindspeedZeroImputer().fit(fit).fill_value_ == 0.0


def test_atemp_rebuild_exact(spark):
    rng = np.random.default_rng(0)
    t, h = rng.uniform(0, 35, 50), rng.uniform(10, 90, 50)
    a = 2 + 0.9 * t + 0.05 * h
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(t, h, a)],
                               "temp double, humidity double, atemp double")
    out = AtempRecalibrator().fit(df).transform(df).select("atemp").collect()
    assert max(abs(r["atemp"] - v) for r, v in zip(out, a)) < 1e-6

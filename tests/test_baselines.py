"""Baseline models: the reference's hand-computed cases."""
import pytest

from cadence.operators.baselines import HourlyMeanBaseline, MeanBaseline


def test_mean_baseline(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (30.0,)], "y double")
    out = MeanBaseline().fit(df, "y").predict(df).collect()
    assert [r["pred"] for r in out] == [20.0, 20.0, 20.0]


def test_hourly_mean(spark):
    df = spark.createDataFrame([(0, 10.0), (0, 20.0), (1, 100.0), (1, 200.0), (2, 50.0)], "hour int, y double")
    m = HourlyMeanBaseline().fit(df, "y")
    got = {r["hour"]: r["pred"] for r in m.predict(df).collect()}
    assert got == {0: 15.0, 1: 150.0, 2: 50.0}


def test_unseen_hour_falls_back_to_global_mean(spark):
    df = spark.createDataFrame([(0, 10.0), (0, 20.0), (1, 100.0), (1, 200.0)], "hour int, y double")
    ask = spark.createDataFrame([(5,)], "hour int")
    assert HourlyMeanBaseline().fit(df, "y").predict(ask).first()["pred"] == pytest.approx(82.5)


def test_hourly_mean_requires_hour(spark):
    df = spark.createDataFrame([(1.0,)], "y double")
    with pytest.raises(ValueError):
        HourlyMeanBaseline().fit(df, "y")

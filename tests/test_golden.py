"""The minimum slice (hourly table -> features -> day-of-month split -> hourly means
-> four metrics) reproduces the values measured with plain SQL in SURVEY 7.2."""
import pytest

from cadence.plans.registry import QUERIES, load_all

from .conftest import SF01

load_all()


def test_minimum_slice_golden_values(spark):
    r = QUERIES["m13_holdout_hourly_mean_hourly"](spark, SF01).first()
    assert (r["rmsle"], r["rmse"], r["mae"], r["r2"]) == pytest.approx((0.273728, 3.956014, 3.160417, -0.075459))
    assert r["n_holdout"] == 96

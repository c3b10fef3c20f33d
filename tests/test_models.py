"""Learners: closed-form ridge parity, non-negative predictions, statistical ordering."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.config import PUBLISHED_PARAMS, LINEAR_PASSTHROUGH
from cadence.functions import features as fx
from cadence.operators import explain as ex
from cadence.operators.baselines import HourlyMeanBaseline, MeanBaseline
from cadence.operators.learners import LinearSpec, RidgeLog, get_model


def _hourly_frame(spark, n=300, seed=0, sd=40.0):
    rng = np.random.default_rng(seed)
    start = dt.datetime(2011, 1, 1)
    rows = []
    for h in range(n):
        t = start + dt.timedelta(hours=h)
        rows.append((t, h, int(rng.integers(1, 5)), 0, int(t.weekday() < 5), int(rng.integers(1, 4)),
                     float(rng.uniform(0, 35)), float(rng.uniform(0, 40)), float(rng.uniform(10, 90)),
                     float(rng.uniform(0, 30)), float(abs(rng.normal(100, sd)))))
    schema = ("datetime timestamp_ntz, row_id long, season int, holiday int, workingday int, weather int, "
              "temp double, atemp double, humidity double, windspeed double, count double")
    return fx.build_features(spark.createDataFrame(rows, schema))


def test_ridge_matches_closed_form(spark):
    df = _hourly_frame(spark, 200, seed=1, sd=30.0)
    spec = LinearSpec()
    fitted = RidgeLog(1.0, spec).fit(df, "count")
    pdf = df.toPandas()
    x_num = pdf[list(spec.numeric)].to_numpy(float)
    x_num = (x_num - x_num.mean(0)) / np.where(x_num.std(0) > 0, x_num.std(0), 1.0)
    x_pass = pdf[list(LINEAR_PASSTHROUGH)].to_numpy(float)
    oh = [(pdf[c].to_numpy()[:, None] == np.sort(pdf[c].unique())[None, :]).astype(float) for c in ("season", "weather")]
    x = np.hstack([x_num, x_pass, *oh])
    y = np.log1p(pdf["count"].to_numpy(float))
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 1.0 * np.eye(x.shape[1]), xc.T @ yc)
    b = y.mean() - x.mean(0) @ w
    expect = np.clip(np.expm1(x @ w + b), 0, None)
    got = fitted.predict(df).select("pred").toPandas()["pred"].to_numpy()
    assert np.max(np.abs(got - expect)) < 1e-9 * max(1.0, np.max(expect))


def test_ridge_predictions_non_negative(spark):
    df = _hourly_frame(spark, 200, seed=2, sd=30.0)
    out = get_model("ridge", PUBLISHED_PARAMS["ridge"]).fit(df, "count").predict(df)
    row = out.agg(F.min("pred").alias("lo"), F.avg("pred").alias("m")).first()
    assert row["lo"] >= 0 and row["m"] > 10


@pytest.mark.parametrize("name", ["random_forest", "gradient_boosting", "xgboost"])
def test_tree_predictions_non_negative(spark, name):
    df = _hourly_frame(spark, 300, seed=3)
    out = get_model(name, {**PUBLISHED_PARAMS[name], "n_estimators": 5}).fit(df, "count").predict(df)
    assert out.agg(F.min("pred")).first()[0] >= 0


def test_unknown_model_name():
    with pytest.raises(ValueError):
        get_model("nope")


def test_permutation_importance_driver_beats_noise(spark):
    rng = np.random.default_rng(42)
    drv, noise = rng.uniform(0, 20, 200), rng.uniform(0, 20, 200)
    y = 10 + 5 * drv
    rows = [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(drv, noise, y))]
    df = spark.createDataFrame(rows, "row_id long, driver double, noise double, y double")
    spec = LinearSpec(numeric=["driver", "noise"], passthrough=[], one_hot=[])
    model = RidgeLog(1.0, spec).fit(df, "y")
    imp = {r["feature"]: r["importance_mean"] for r in
           ex.permutation_importance(model, df, "y", ["driver", "noise"], "row_id", 5, 42).collect()}
    assert imp["driver"] > imp["noise"] and imp["driver"] > 0


def test_model_roundtrip(spark, tmp_path):
    from cadence.sources import io
    df = _hourly_frame(spark, 120, seed=4)
    fitted = get_model("ridge", PUBLISHED_PARAMS["ridge"]).fit(df, "count")
    path = io.save_fitted(fitted, str(tmp_path / "m"))
    loaded = io.load_fitted(spark, path)
    a = [r["pred"] for r in fitted.predict(df).orderBy("row_id").collect()]
    b = [r["pred"] for r in loaded.predict(df).orderBy("row_id").collect()]
    assert a == b


def test_importance_of_unread_features_is_zero_and_they_are_not_carried(spark):
    rows = [(i, i % 24, float(i % 24), float(i % 7)) for i in range(240)]
    df = spark.createDataFrame(rows, "row_id long, hour int, y double, noise double")
    model = HourlyMeanBaseline().fit(df, "y")
    out = ex.permutation_importance(model, df, "y", ["noise", "hour"], "row_id", 3, 42)
    got = [(r["feature"], r["importance_mean"]) for r in out.collect()]
    assert got[0][0] == "hour" and got[0][1] > 0 and got[1] == ("noise", 0.0)
    assert "p__noise" not in out._jdf.queryExecution().analyzed().toString()
    none = ex.permutation_importance(MeanBaseline().fit(df, "y"), df, "y", ["noise", "hour"], "row_id", 3, 42)
    assert {tuple(r) for r in none.collect()} == {("noise", 0.0, 0.0), ("hour", 0.0, 0.0)}


def test_shuffled_positions_are_permutations(spark):
    for n in (1, 2, 3, 5, 16, 17, 97, 1000, 1343):
        df = spark.range(n).withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(4))))
        got = ex.shuffled_positions(df.withColumn("p", F.col("id")), "p", "rep", n, 42, 5).collect()
        for rep in range(5):
            assert sorted(r["p"] for r in got if r["rep"] == rep) == list(range(n))
    moved = {rep: [r["p"] for r in sorted(got, key=lambda r: r["id"]) if r["rep"] == rep] for rep in range(5)}
    assert len({tuple(v) for v in moved.values()}) == 5
    for v in moved.values():   # no trace of the order left
        assert abs(np.corrcoef(v, range(n))[0, 1]) < 0.1 and sum(a == i for i, a in enumerate(v)) < 10
        assert abs(np.corrcoef(v[:-1], v[1:])[0, 1]) < 0.1


def test_pairs_hold_every_row_once_a_repeat(spark):
    df = spark.createDataFrame([(i * 3 + 1, float(i)) for i in range(50)], "row_id long, x double")
    rows = ex.permutation_pairs(df, "row_id", ["x"], 7, 4).collect()
    for rep in range(4):
        own = [r for r in rows if r["_rep"] == rep]
        assert sorted(r["x"] for r in own) == sorted(r["p__x"] for r in own) == [float(i) for i in range(50)]

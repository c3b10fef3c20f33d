"""Published settings are the default, and no parameter or fault passes in silence."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.config import PUBLISHED_PARAMS, SEARCH_SPACE, Config
from cadence.operators import experiments as xp
from cadence.operators import profile as pr
from cadence.operators.baselines import HourlyMeanBaseline, MeanBaseline
from cadence.operators.learners import get_model
from cadence.operators.trees import Settings
from cadence.operators.order import exact_quantiles, quantile_edges
from cadence.session import scratch_path
from cadence.sources import io


def test_published_settings_are_built():
    cfg = Config()
    assert cfg.params == PUBLISHED_PARAMS
    made = {m: get_model(m, cfg.params[m]).settings() for m in ("random_forest", "gradient_boosting", "xgboost")}
    assert made["random_forest"] == Settings(300, bootstrap=True, min_rows=2)
    assert made["gradient_boosting"] == Settings(300, 0.05, 3, 0.9)
    assert made["xgboost"] == Settings(400, 0.05, 5, 0.9, tree_columns=0.9, min_weight=1.0, leaf_penalty=1.0)
    searched = get_model("xgboost", {k: v[-1] for k, v in SEARCH_SPACE["xgboost"].items()}).settings()
    assert searched == Settings(800, 0.1, 8, 1.0, tree_columns=1.0, min_weight=5, leaf_penalty=5.0)
    searched = get_model("gradient_boosting", {k: v[0] for k, v in SEARCH_SPACE["gradient_boosting"].items()}).settings()
    assert searched == Settings(200, 0.02, 2, 0.7, node_columns="sqrt", min_rows=1)


@pytest.mark.parametrize("name,params", [("xgboost", {"gamma": 1.0}), ("gradient_boosting", {"rounds": 3}),
                                         ("random_forest", {"learning_rate": 0.1})])
def test_parameters_without_effect_raise(name, params):
    with pytest.raises(ValueError):
        get_model(name, params)


def test_quantiles_with_nan_and_heavy_ties(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate((np.full(3000, 7.0), rng.normal(size=500), np.arange(10.0)))
    rows = [(i % 3 if i % 7 else None, float(v)) for i, v in enumerate(values)] + [(0, math.nan), (1, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    probs = [0.0, 0.2, 0.25, 0.5, 0.999, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in (None, 0, 1, 2):
        own = [v for k, v in rows if k == g and v is not None and not math.isnan(v)]
        for p in probs:
            assert got[g, p] == pytest.approx(np.quantile(own, p), abs=1e-12)
    tens = spark.createDataFrame([(float(i),) for i in range(10)] + [(math.nan,)], "v double")
    assert quantile_edges(tens, "v", 5) == pytest.approx([0.0, 1.8, 3.6, 5.4, 7.2, 9.0])


def test_histogram_has_every_bin_and_no_nan(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (math.nan,), (None,)], "v double")
    got = {r["bin"]: r["n"] for r in pr.histogram(df, "v", 5).collect()}
    assert got == {0: 1, 1: 0, 2: 0, 3: 0, 4: 1}


def test_gate_needs_every_tree(spark):
    ridge = [("ridge", "a", 0.05)]
    trees = [(m, "a", -0.001) for m in ("random_forest", "gradient_boosting", "xgboost")]
    for rows, want in ((ridge, 0), (ridge + trees[:2], 0), (ridge + trees, 1)):
        gate = xp.promotion_gate(spark.createDataFrame(rows, "model string, arm string, improvement double"))
        assert [r["qualifies"] for r in gate.collect()] == [want]


def test_baselines_are_saved_and_loaded(spark):
    df = spark.createDataFrame([(1, 4.0), (1, 6.0), (2, 10.0)], "hour int, count double")
    for est in (MeanBaseline(), HourlyMeanBaseline()):
        fitted = est.fit(df, "count")
        again = io.load_fitted(spark, io.save_fitted(fitted, scratch_path(spark, "baseline")))
        more = df.unionByName(spark.createDataFrame([(9, 0.0)], "hour int, count double"))
        total = lambda m: m.predict(more).agg(F.sum("pred")).first()[0]
        assert total(again) == pytest.approx(total(fitted))
    with pytest.raises(FileNotFoundError, match="no saved model"):
        io.load_fitted(spark, scratch_path(spark, "nothing"))

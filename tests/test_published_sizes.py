"""The registered searches and sweeps ask for every published model, draw, arm, view and
fold, and run to their end on a table of a few days with few rounds."""
import json

import pytest
from pyspark.sql import functions as F

from cadence.config import FEATURE_GROUPS, SEARCH_DRAWS, SEARCH_SPACE, Config
from cadence.operators import experiments as xp
from cadence.operators import validate as va
from cadence.operators.learners import get_model
from cadence.operators.splits import ranked_with_folds
from cadence.plans import q_experiments as qx
from cadence.plans.q_splits import lab2

from .conftest import SF001

FOUR = ["ridge", "random_forest", "gradient_boosting", "xgboost"]
SMALL = {"ridge": {"alpha": 1.0}, "random_forest": {"n_estimators": 30, "min_samples_leaf": 2},
         "gradient_boosting": {"n_estimators": 4, "learning_rate": 0.3, "max_depth": 2},
         "xgboost": {"n_estimators": 4, "learning_rate": 0.3, "max_depth": 3, "colsample_bytree": 0.9}}
CFG = Config(params=SMALL)


@pytest.fixture
def asked(monkeypatch):
    """The fits that reach the two engines, which answer with the labels themselves."""
    fits = []

    def answer(frame, made, cfg):
        fits.extend(made)
        parts = [frame.rows.filter(frame.views[f.view].validates == f.fold).limit(3).select(
            F.lit(i).alias("fit"), F.col("rank").alias("key"), F.log1p("count").alias("y"), (F.log1p("count") + 0.1).alias("log_pred"))
            for i, f in list(enumerate(made))[:1]]
        rows = parts[0]
        return rows.withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(len(made) - 1))))

    monkeypatch.setattr(xp, "_tree_scores", answer)
    monkeypatch.setattr(xp, "_ridge_scores", answer)
    monkeypatch.setattr(qx, "_ledger", lambda spark: None)
    return fits


def test_searches_have_both_models_and_all_draws(spark, asked):
    rows = qx.m22(spark, SF001).collect()
    assert {m: sum(r["model"] == m for r in rows) for m in SEARCH_DRAWS} == SEARCH_DRAWS
    assert len(asked) == 5 * sum(SEARCH_DRAWS.values())
    assert {(f.view, f.fold) for f in asked} == {(0, k) for k in range(1, 6)}
    for m, space in SEARCH_SPACE.items():
        drawn = [json.loads(r["params"]) for r in rows if r["model"] == m]
        assert all(d.keys() == space.keys() and all(d[k] in space[k] for k in d) for d in drawn)
        assert len({json.dumps(d, sort_keys=True) for d in drawn}) == SEARCH_DRAWS[m]
    asked.clear()
    assert {r["model"] for r in qx.m23(spark, SF001).collect()} == set(SEARCH_DRAWS)
    assert len(asked) == 5 * sum(SEARCH_DRAWS.values()) + 4 * 6   # and both arms of both models, on both views


def test_sweeps_have_four_models_and_all_arms(spark, asked):
    rows = qx.m25(spark, SF001).collect()
    assert {(r["arm"], r["model"]) for r in rows} == {(a, m) for a in ("baseline", *FEATURE_GROUPS) for m in FOUR}
    assert len(asked) == 5 * 4 * 6
    assert {r["arm"] for r in qx.m29(spark, SF001).collect()} == set(FEATURE_GROUPS)
    asked.clear()
    rows = qx.m26(spark, SF001).collect()
    assert {(r["arm"], r["model"]) for r in rows} == {(a, m) for a in ("baseline", "comfort", "recalib", "all") for m in FOUR}
    rebuilt = [f for f in asked if any("__" in str(c) for c in f.columns)]
    assert len(asked) == 96 and len(rebuilt) == 48
    asked.clear()
    assert [r["model"] for r in qx.m24m(spark, SF001).collect()] == FOUR
    assert len(asked) == 4 * 2 * 5 and {f.view for f in asked} == {0, 1}


def test_a_small_sweep_and_search_run_to_the_end(spark):
    df = qx._cand(spark, SF001)
    got = {(r["arm"], r["model"]): r for r in xp.feature_sweep(df, FOUR, CFG, {"peaks": FEATURE_GROUPS["peaks"]}).collect()}
    assert len(got) == 8 and all(r["holdout_rmsle"] > 0 and r["cv_rmsle"] > 0 for r in got.values())
    # the same figures as one fit after another through the estimators
    base = got["baseline", "ridge"]
    pred = va.fit_predict(get_model("ridge", SMALL["ridge"]))
    alone = va.evaluate_holdout(pred, df, CFG).first()
    cv = va.cv_report(pred, df, CFG).agg(F.avg("rmsle")).first()[0]
    assert abs(base["holdout_rmsle"] - alone["rmsle"]) < 1e-4 and abs(base["holdout_r2"] - alone["r2"]) < 1e-4 and abs(base["cv_rmsle"] - cv) < 1e-4
    env = xp.env_experiment(df, ["ridge", "gradient_boosting"], CFG)
    assert env.count() == 8 and env.filter("holdout_rmsle is null or cv_rmsle is null").isEmpty()
    space = {k: v for k, v in SEARCH_SPACE["gradient_boosting"].items()} | {"n_estimators": [2, 3]}
    search = xp.random_search(df, "gradient_boosting", space, 4, CFG)
    tuned = xp.tuned_against_baseline(df, {"gradient_boosting": search}, CFG).first()
    assert tuned["arm"] == "tuned" and tuned["search_best_cv_rmsle"] == search.agg(F.min("cv_rmsle")).first()[0]


def test_ridge_from_one_scan_equals_a_fit_per_fold(spark):
    df = lab2(spark, SF001)
    pred = va.fit_predict(get_model("ridge", {"alpha": 1.0}))
    alone = {r["fold"]: r for r in va.cv_report(pred, df, CFG, folds=ranked_with_folds(df, CFG)).collect()}
    for r in xp.cross_validation(df, xp.Job("ridge", {"alpha": 1.0}), CFG).collect():
        for m in ("rmsle", "rmse", "mae", "r2"):
            assert abs(r[m] - alone[r["fold"]][m]) < 1e-9
        assert r["n"] == alone[r["fold"]]["n"]


def test_a_ledger_runs_only_what_is_missing(spark, tmp_path, monkeypatch):
    ran = []
    real = xp._tree_scores
    monkeypatch.setattr(xp, "_tree_scores", lambda frame, fits, cfg: (ran.append(len(fits)), real(frame, fits, cfg))[1])
    monkeypatch.setattr(xp, "LEDGER_FITS", 4)
    df, space = lab2(spark, SF001), {"n_estimators": [1, 2], "max_depth": [1, 2], "learning_rate": [0.5]}
    ledger = xp.Ledger(spark, str(tmp_path / "ledger"))
    first = xp.random_search(df, "gradient_boosting", space, 2, CFG, ledger).collect()
    assert ran == [4, 4, 2]                        # batches, each written as it ends
    ran.clear()
    assert xp.random_search(df, "gradient_boosting", space, 2, CFG, ledger).collect() == first and ran == []
    more = xp.random_search(df, "gradient_boosting", space | {"learning_rate": [0.4]}, 1, CFG, ledger).collect()
    assert ran == [4, 1] and len(more) == 1
    ran.clear()
    changed = df.withColumn("temp", F.col("temp") + F.when(F.col("row_id") % 50 == 0, 1.0).otherwise(0.0))
    xp.random_search(changed, "gradient_boosting", space, 1, CFG, ledger).collect()
    assert ran == [4, 1]                           # another input is another fit
    alone = xp.random_search(df, "gradient_boosting", space, 2, CFG).collect()
    assert [r["cv_rmsle"] for r in alone] == [r["cv_rmsle"] for r in first]

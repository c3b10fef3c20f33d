from cadence.operators import experiments as xp
from cadence.plans.q_fitted import smearing_gate

# BASELINE section 7: holdout RMSLE improvement over the recorded baseline.
SWEEP = {
    "interaction_harmonic": {"ridge": 0.1871, "random_forest": 0.0012, "gradient_boosting": 0.0216, "xgboost": 0.0024},
    "peaks": {"ridge": 0.135, "random_forest": -0.0013, "gradient_boosting": 0.0004, "xgboost": 0.002},
    "environmental": {"ridge": 0.0007, "random_forest": -0.0049, "gradient_boosting": -0.0093, "xgboost": -0.0058},
    "year_trend": {"ridge": 0.0316, "random_forest": -0.0002, "gradient_boosting": -0.0001, "xgboost": -0.0005},
    "all": {"ridge": 0.2653, "random_forest": -0.0007, "gradient_boosting": 0.0182, "xgboost": -0.0003},
}


def test_promotion_gate_on_published_sweep(spark):
    rows = [(g, m, v) for g, d in SWEEP.items() for m, v in d.items()]
    cmp = spark.createDataFrame(rows, "arm string, model string, improvement double")
    gate = xp.promotion_gate(cmp)
    got = {r["arm"]: r["qualifies"] for r in gate.collect()}
    assert got == {"interaction_harmonic": 1, "peaks": 1, "environmental": 0, "year_trend": 1, "all": 1}
    assert xp.promotion_winner(gate).first()["arm"] == "interaction_harmonic"


def _metrics(spark, rows):
    return spark.createDataFrame(rows, "model string, rmsle double, rmse double, mae double, r2 double")


def test_no_regression_gate_rejects_dual_target_and_tuning(spark):
    # BASELINE sections 3 and 4 (holdout): neither arm gains 0.01 RMSLE.
    base = _metrics(spark, [("xgboost", 0.3064, 47.5398, 28.0005, 0.9325),
                            ("gradient_boosting", 0.312, 51.6604, 31.0468, 0.9203)])
    dual = _metrics(spark, [("xgboost", 0.3073, 45.7551, 27.0638, 0.9375),
                            ("gradient_boosting", 0.3136, 51.194, 30.6048, 0.9217)])
    tuned = _metrics(spark, [("xgboost", 0.3056, 47.5398, 28.0005, 0.9325)])
    assert {r["model"]: r["passes"] for r in xp.no_regression_gate(base, dual).collect()} == {
        "xgboost": 0, "gradient_boosting": 0}
    assert xp.no_regression_gate(base, tuned).first()["passes"] == 0


def test_no_regression_gate_accepts_clear_gain(spark):
    base = _metrics(spark, [("ridge", 0.9055, 150.0, 100.0, 0.3)])
    arm = _metrics(spark, [("ridge", 0.7184, 140.8, 89.1, 0.41)])
    assert xp.no_regression_gate(base, arm).first()["passes"] == 1


def test_smearing_gate_on_published_peak_experiment(spark):
    # BASELINE section 5: smearing improves RMSE, MAE and the top-fifth bias.
    overall = spark.createDataFrame(
        [("uncorrected", 0.3064, 47.5398, 28.0005, 0.9325), ("smeared", 0.3053, 47.0814, 27.6557, 0.9338)],
        "arm string, rmsle double, rmse double, mae double, r2 double")
    by_bin = spark.createDataFrame(
        [("uncorrected", 5, -32.93), ("smeared", 5, -22.97), ("uncorrected", 1, 0.97), ("smeared", 1, 1.27)],
        "arm string, bin int, mean_bias double")
    r = smearing_gate(overall, by_bin).first()
    assert r["passes"] == 1 and r["top_bias_uncorrected"] == -32.93


def test_leaderboard_and_best_model(spark):
    res = spark.createDataFrame([("ridge", 0.7184), ("xgboost", 0.3064), ("mean_baseline", 1.5313)],
                                "model string, rmsle double")
    assert [r["model"] for r in xp.leaderboard(res).collect()] == ["xgboost", "ridge", "mean_baseline"]
    assert xp.best_model(res).first()["best_model"] == "xgboost"


def test_random_draws_are_seeded_and_distinct():
    from cadence.config import SEARCH_SPACE
    a = xp.draw_params(SEARCH_SPACE["xgboost"], 40, 42)
    b = xp.draw_params(SEARCH_SPACE["xgboost"], 40, 42)
    assert a == b and len({tuple(sorted(d.items())) for d in a}) == 40

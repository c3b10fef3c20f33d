"""Registered queries for experiments, gates and result tables: M22, M23, M25, M26,
M28, M29, M30, D5, W2, W3. Closed-form models (M1, M2, the log-space hourly mean)
have oracles; learner sweeps get the rows-only check."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from cadence.config import (CANDIDATE_NUMERIC, FEATURE_GROUPS, LINEAR_NUMERIC, LINEAR_PASSTHROUGH, SEARCH_DRAWS, SEARCH_SPACE,
                            Config)
from cadence.functions import features as fx
from cadence.operators import baselines as bl
from cadence.operators import correct as co
from cadence.operators import experiments as xp
from cadence.operators import validate as va
from cadence.operators.dual import dual_predictor
from cadence.plans.common import finish, i, r
from cadence.plans.fixtures_sql import with_
from cadence.plans.q_features import CANDIDATE_CTE
from cadence.plans.q_learners import ridge_cv_ctes
from cadence.plans.q_models import _base
from cadence.plans.q_splits import lab2
from cadence.plans.registry import query
from cadence.plans.ridge_sql import BACK, recursive, ridge_ctes
from cadence.plans.sqlparts import report_sql_raw
from cadence.session import ensure_checkpoint_dir
from cadence.sources.fixtures import demand_rows, labeled

CFG = Config()
B = _base()


def _cand(spark, sf):
    return fx.build_candidate_features(labeled(demand_rows(spark, sf)), CFG)


# --- learner sweeps (rows-only) ------------------------------------------------------------------
#: The learners of the published sweeps and of the gap diagnostic.
MODELS = ("ridge", "random_forest", "gradient_boosting", "xgboost")

def _ledger(spark):
    """Finished fits of these queries, in the shared folder: m29 judges the sweep of m25,
    and m23 refits the search of m22, without running their fits again."""
    return xp.Ledger(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledger")


@query("m25_feature_group_sweep")
def m25(spark, sf):
    """Baseline arm and the four candidate groups, four models on both validation views."""
    return finish(xp.feature_sweep(_cand(spark, sf), MODELS, CFG, ledger=_ledger(spark)))


@query("m29_promotion_gate")
def m29(spark, sf):
    """The gate on the sweep of m25."""
    return finish(xp.promotion_gate(xp.compare_with_baseline(xp.feature_sweep(_cand(spark, sf), MODELS, CFG, ledger=_ledger(spark)))))


@query("m26_env_experiment")
def m26(spark, sf):
    """Baseline, comfort, recalib (fitted inside each fold) and all, with four models."""
    return finish(xp.env_experiment(_cand(spark, sf), MODELS, CFG, _ledger(spark)))


# --- the sweeps with the ridge alone: a linear solve in SQL ------------------------------------------
_SPLITS = [*ridge_cv_ctes(), "tq AS (SELECT f, rid, * EXCLUDE (f, rid, rank, n_all, val_fold, train_seg) FROM tq0 UNION ALL SELECT 9, row_id, * FROM tr)",
           "vq AS (SELECT f, rid, * EXCLUDE (f, rid, rank, n_all, val_fold, train_seg) FROM vq0 UNION ALL SELECT 9, row_id, * FROM ho)"]
_CAND_B = [B[0], B[1], CANDIDATE_CTE, "lab AS (SELECT *, CAST(CASE WHEN year = 2012 THEN 1 ELSE 0 END AS BIGINT) AS is_2012 FROM cand WHERE day(datetime) < 20)", *B[3:]]
_MEASURES = ("rmsle", "rmse", "mae", "r2")


def _even(x: str) -> str:
    """Half-even rounding to the records' four places."""
    return f"round_even({x}, 4)"


def _sweep_ctes(arms: dict[str, tuple[tuple[str, ...], str, str]]) -> list[str]:
    """``sweep`` (arm, model, metrics as recorded) of arms: extra columns, and the tables
    of training and judged rows."""
    out, parts = [], []
    for k, (arm, (extra, train, judged)) in enumerate(arms.items()):
        num = tuple(c for c in extra if c in CANDIDATE_NUMERIC)
        rest = tuple(c for c in extra if c not in CANDIDATE_NUMERIC)
        out += ridge_ctes(train, judged, numeric=(*LINEAR_NUMERIC, *num), passthrough=(*LINEAR_PASSTHROUGH, *rest), tag=str(k))
        out += [f"ap{k} AS (SELECT v.f, v.count AS y, {BACK.format('log_pred')} AS pred FROM {judged} v JOIN rp{k} p ON p.f = v.f AND p.rid = v.rid)",
                f"af{k} AS (SELECT f, {report_sql_raw()} FROM ap{k} GROUP BY f)"]
        held = ", ".join(f"{_even(f'max({m}) FILTER (WHERE f = 9)')} AS holdout_{m}" for m in _MEASURES)
        parts.append(f"SELECT '{arm}' AS arm, 'ridge' AS model, {held}, {_even('avg(rmsle) FILTER (WHERE f < 9)')} AS cv_rmsle FROM af{k}")
    return [*out, "sweep AS (" + " UNION ALL ".join(parts) + ")"]


_ALL_SWEPT = "SELECT arm, model, " + ", ".join(f"{r(c)} AS {c}" for c in (*(f"holdout_{m}" for m in _MEASURES), "cv_rmsle")) + " FROM sweep"
_GROUP_ARMS = {a: (tuple(c), "tq", "vq") for a, c in {"baseline": (), **FEATURE_GROUPS}.items()}


@query("m25_feature_group_sweep_ridge", recursive(with_(*_CAND_B, *_SPLITS, *_sweep_ctes(_GROUP_ARMS))) + _ALL_SWEPT)
def m25r(spark, sf):
    """The five arms of the sweep with the ridge."""
    return finish(xp.feature_sweep(_cand(spark, sf), ["ridge"], CFG))


@query("m29_promotion_gate_ridge", recursive(with_(*_CAND_B, *_SPLITS, *_sweep_ctes(_GROUP_ARMS),
       "gain AS (SELECT a.arm, round(b.holdout_rmsle - a.holdout_rmsle, 4) AS g FROM sweep a JOIN sweep b ON b.arm = 'baseline' WHERE a.arm <> 'baseline')")) +
       f"SELECT arm, CAST(NULL AS DOUBLE) AS best_boosted_gain, {r('g')} AS ridge_gain, CAST(NULL AS DOUBLE) AS worst_tree_gain, {r('g')} AS worst_gain, "
       f"{r('g')} AS best_gain, {i('0')} AS qualifies, {i('CASE WHEN g >= 0 THEN 1 ELSE 0 END')} AS no_loss FROM gain")
def m29r(spark, sf):
    """The gate on the ridge's arms alone: without trees that show no loss none qualifies."""
    return finish(xp.promotion_gate(xp.compare_with_baseline(xp.feature_sweep(_cand(spark, sf), ["ridge"], CFG))))


_REBUILT = ["wm AS (SELECT f, coalesce(median(windspeed) FILTER (WHERE windspeed > 0), 0.0) AS fill FROM tq GROUP BY f)",
            "om AS (SELECT f, avg(temp) AS m1, avg(humidity) AS m2, avg(atemp) AS my, var_pop(temp) AS v1, var_pop(humidity) AS v2, "
            "covar_pop(temp, humidity) AS v12, covar_pop(temp, atemp) AS c1, covar_pop(humidity, atemp) AS c2 FROM tq GROUP BY f)",
            "ob AS (SELECT *, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2 FROM om)",
            *[f"{name}r AS (SELECT q.* REPLACE (CASE WHEN q.windspeed = 0 THEN wm.fill ELSE q.windspeed END AS windspeed, "
              f"(ob.my - ob.b1 * ob.m1 - ob.b2 * ob.m2) + ob.b1 * q.temp + ob.b2 * q.humidity AS atemp) FROM {name} q JOIN wm ON wm.f = q.f JOIN ob ON ob.f = q.f)"
              for name in ("tq", "vq")]]
_ENV = {"baseline": ((), "tq", "vq"), "comfort": (("comfort_index",), "tq", "vq"), "recalib": ((), "tqr", "vqr"), "all": (("comfort_index",), "tqr", "vqr")}


@query("m26_env_experiment_ridge", recursive(with_(*_CAND_B, *_SPLITS, *_REBUILT, *_sweep_ctes(_ENV))) + _ALL_SWEPT)
def m26r(spark, sf):
    """The four arms of the weather experiment with the ridge."""
    return finish(xp.env_experiment(_cand(spark, sf), ["ridge"], CFG))


# --- the search with the ridge's penalty: each draw is a linear solve in SQL ---------------------------
RIDGE_SPACE = {"alpha": [0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0]}
RIDGE_DRAWS = 4
_DRAWN = xp.draw_params(RIDGE_SPACE, RIDGE_DRAWS, CFG.seed)
_SEARCH_FOLDS = ridge_cv_ctes(0, 20, "s15")
_SEARCHED = ["s15 AS (SELECT * FROM lab WHERE day(datetime) < 16)", *_SEARCH_FOLDS]
for _k, _p in enumerate(_DRAWN):
    _SEARCHED += [*ridge_ctes("tq20", "vq20", alpha=_p["alpha"], tag=f"_d{_k}"),
                  f"sp{_k} AS (SELECT v.f, v.count AS y, {BACK.format('log_pred')} AS pred FROM vq20 v JOIN rp_d{_k} p ON p.f = v.f AND p.rid = v.rid)",
                  f"sf{_k} AS (SELECT f, {report_sql_raw()} FROM sp{_k} GROUP BY f)"]
_SEARCHED.append("found AS (" + " UNION ALL ".join(
    f"SELECT {k} AS draw, '{json.dumps(p, sort_keys=True)}' AS params, avg(rmsle) AS cv FROM sf{k}" for k, p in enumerate(_DRAWN)) + ")")


def _ridge_search(spark, sf):
    return xp.random_search(lab2(spark, sf), "ridge", RIDGE_SPACE, RIDGE_DRAWS, CFG)


@query("m22_random_search_ridge", recursive(with_(*B, *_SEARCHED)) +
       f"SELECT {i('draw')} AS draw, 'ridge' AS model, params, {r('cv')} AS cv_rmsle, {r('-cv')} AS score FROM found")
def m22r(spark, sf):
    """Seeded draws of the ridge's penalty, scored by CV RMSLE on days 1-15."""
    return finish(_ridge_search(spark, sf))


def _m23r_sql():
    ctes, arms = [], {"baseline": CFG.params["ridge"], **{f"d{k}": p for k, p in enumerate(_DRAWN)}}
    for arm, p in arms.items():
        ctes += [*ridge_ctes("tq", "vq", alpha=p["alpha"], tag=f"_h{arm}"),
                 f"ap_{arm} AS (SELECT v.f, v.count AS y, {BACK.format('log_pred')} AS pred FROM vq v JOIN rp_h{arm} p ON p.f = v.f AND p.rid = v.rid)",
                 f"af_{arm} AS (SELECT f, {report_sql_raw()} FROM ap_{arm} GROUP BY f)"]
    held = ", ".join(f"{_even(f'max({m}) FILTER (WHERE f = 9)')} AS holdout_{m}" for m in _MEASURES)
    every = " UNION ALL ".join(f"SELECT '{a}' AS arm, {held}, {_even('avg(rmsle) FILTER (WHERE f < 9)')} AS cv_rmsle FROM af_{a}" for a in arms)
    ctes += [f"swept AS ({every})", "best AS (SELECT * FROM found ORDER BY cv, draw LIMIT 1)"]
    cols = ", ".join(f"{r('a.' + c)} AS {c}" for c in (*(f"holdout_{m}" for m in _MEASURES), "cv_rmsle"))
    return recursive(with_(*B, *_SPLITS, *_SEARCHED, *ctes)) + (
        f"SELECT 'ridge' AS model, 'tuned' AS arm, {cols}, {r('b.holdout_rmsle')} AS baseline_rmsle, {r('b.holdout_rmsle - a.holdout_rmsle')} AS improvement, "
        f"{r('best.cv')} AS search_best_cv_rmsle FROM best JOIN swept a ON a.arm = 'd' || CAST(best.draw AS VARCHAR) JOIN swept b ON b.arm = 'baseline'")


@query("m23_tuned_vs_baseline_ridge", _m23r_sql())
def m23r(spark, sf):
    """The best drawn penalty against the published one on both views."""
    return finish(xp.tuned_against_baseline(lab2(spark, sf), {"ridge": _ridge_search(spark, sf)}, CFG))


def _searches(spark, sf):
    """Both boosted models' published searches: seeded draws from the published spaces,
    scored by CV RMSLE on days 1-15 only."""
    return {m: xp.random_search(lab2(spark, sf), m, SEARCH_SPACE[m], n, CFG, _ledger(spark)) for m, n in SEARCH_DRAWS.items()}


@query("m22_random_search")
def m22(spark, sf):
    """The searches' draws and scores."""
    a, b = _searches(spark, sf).values()
    return finish(a.unionByName(b))


@query("m23_tuned_vs_baseline")
def m23(spark, sf):
    """The searches again, and their best draws against the published settings."""
    return finish(xp.tuned_against_baseline(lab2(spark, sf), _searches(spark, sf), CFG, _ledger(spark)))


_GAPS = [*ridge_cv_ctes(0, 0), *ridge_cv_ctes(48, 10),
         "tq AS (SELECT * FROM tq0 UNION ALL SELECT * FROM tq10)", "vq AS (SELECT * FROM vq0 UNION ALL SELECT * FROM vq10)", *ridge_ctes("tq", "vq"),
         f"gp AS (SELECT v.f, v.count AS y, {BACK.format('log_pred')} AS pred FROM vq v JOIN rp ON rp.f = v.f AND rp.rid = v.rid)",
         f"gf AS (SELECT f, {report_sql_raw()} FROM gp GROUP BY f)",
         "gm AS (SELECT avg(rmsle) FILTER (WHERE f < 10) AS a, avg(rmsle) FILTER (WHERE f > 10) AS b FROM gf)"]


@query("m24_gap_diagnostic_ridge", recursive(with_(*B, *_GAPS)) + f"SELECT 'ridge' AS model, {r('a')} AS cv_rmsle_gap0, {r('b')} AS cv_rmsle_gap48, {r('b - a')} AS delta FROM gm")
def m24r(spark, sf):
    """Gap 0 against gap 48 for the ridge."""
    return finish(xp.gap_diagnostic(lab2(spark, sf), ["ridge"], CFG))


@query("m24_gap_diagnostic_models")
def m24m(spark, sf):
    """Gap 0 against gap 48 for the four models (the learner half of M24)."""
    return finish(xp.gap_diagnostic(lab2(spark, sf), MODELS, CFG))


# --- closed-form arms: D5, M30 ---------------------------------------------------------------------
_ARMS_SQL = [
    "hm AS (SELECT hour, avg(count) AS m, avg(casual) AS mc, avg(registered) AS mr FROM tr GROUP BY hour)",
    "gm AS (SELECT avg(count) AS g, avg(casual) AS gc, avg(registered) AS gr FROM tr)",
    "lm AS (SELECT hour, avg(ln(1 + count)) AS m FROM tr GROUP BY hour)",
    "lg AS (SELECT avg(ln(1 + count)) AS g FROM tr)",
    "pp AS (SELECT ho.row_id, ho.count AS y, gm.g AS p_mean, gm.gc + gm.gr AS p_mean_dual, "
    "coalesce(hm.m, gm.g) AS p_hour, coalesce(hm.mc, gm.gc) + coalesce(hm.mr, gm.gr) AS p_hour_dual, "
    "CASE WHEN exp(coalesce(lm.m, lg.g)) - 1 < 0 THEN 0.0 ELSE exp(coalesce(lm.m, lg.g)) - 1 END AS p_log "
    "FROM ho LEFT JOIN hm USING (hour) LEFT JOIN lm USING (hour) CROSS JOIN gm CROSS JOIN lg)",
]


def _res_sql(rows):
    """(model, arm, pred column) -> holdout metric rows (unrounded)."""
    from cadence.plans.sqlparts import report_sql_raw
    return "res AS (" + " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{a}' AS arm, {report_sql_raw('y', p)} FROM pp" for m, a, p in rows) + ")"


_DUAL_ROWS = [("mean_baseline", "direct_count", "p_mean"), ("mean_baseline", "dual_target", "p_mean_dual"),
              ("hourly_mean_baseline", "direct_count", "p_hour"), ("hourly_mean_baseline", "dual_target", "p_hour_dual")]


def _dual_results(spark, sf):
    df = lab2(spark, sf)
    parts = []
    for name, est in (("mean_baseline", bl.MeanBaseline()), ("hourly_mean_baseline", bl.HourlyMeanBaseline())):
        for arm, pred in (("direct_count", va.fit_predict(est)), ("dual_target", dual_predictor(est))):
            parts.append(va.evaluate_holdout(pred, df, CFG).select(
                F.lit(name).alias("model"), F.lit(arm).alias("arm"), "rmsle", "rmse", "mae", "r2"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("d05_compare_with_baseline", with_(*B, *_ARMS_SQL, _res_sql(_DUAL_ROWS)) +
       f"SELECT a.model, a.arm, {r('a.rmsle')} AS holdout_rmsle, {r('b.rmsle')} AS baseline_rmsle, "
       f"{r('b.rmsle - a.rmsle')} AS improvement FROM res a JOIN res b ON a.model = b.model AND b.arm = 'direct_count' "
       "WHERE a.arm <> 'direct_count'")
def d05(spark, sf):
    res = _dual_results(spark, sf).withColumnRenamed("rmsle", "holdout_rmsle")
    cmp = xp.compare_with_baseline(res, "direct_count")
    return finish(cmp.select("model", "arm", "holdout_rmsle", "baseline_rmsle", "improvement"))


@query("m30_no_regression_gate", with_(*B, *_ARMS_SQL, _res_sql(_DUAL_ROWS)) +
       f"SELECT a.model, {r('b.rmsle - a.rmsle')} AS rmsle_gain, CAST((b.rmsle - a.rmsle >= 0.01 AND a.rmse <= b.rmse "
       "AND a.mae <= b.mae AND a.r2 >= b.r2) AS BIGINT) AS passes FROM res a JOIN res b ON a.model = b.model "
       "AND b.arm = 'direct_count' WHERE a.arm = 'dual_target'")
def m30(spark, sf):
    res = _dual_results(spark, sf)
    base = res.filter(F.col("arm") == "direct_count")
    arm = res.filter(F.col("arm") == "dual_target")
    return finish(xp.no_regression_gate(base, arm))


# --- W2, W3, M28 -----------------------------------------------------------------------------------
_LB_ROWS = [("mean_baseline", "holdout", "p_mean"), ("hourly_mean_baseline", "holdout", "p_hour"),
            ("hourly_log_mean", "holdout", "p_log")]


def _lb(spark, sf):
    df = lab2(spark, sf)
    preds = {"mean_baseline": va.fit_predict(bl.MeanBaseline()),
             "hourly_mean_baseline": va.fit_predict(bl.HourlyMeanBaseline()),
             "hourly_log_mean": va.fit_predict(co.HourlyLogMean())}
    return df, preds, xp.holdout_results(df, preds, CFG)


@query("w02_leaderboard", with_(*B, *_ARMS_SQL, _res_sql(_LB_ROWS)) +
       f"SELECT model, {r('rmsle')} AS rmsle, {r('rmse')} AS rmse, {r('mae')} AS mae, {r('r2')} AS r2 FROM res "
       "ORDER BY rmsle")
def w02(spark, sf):
    _, _, res = _lb(spark, sf)
    return finish(xp.leaderboard(res).select("model", "rmsle", "rmse", "mae", "r2"))


@query("w03_best_model", with_(*B, *_ARMS_SQL, _res_sql(_LB_ROWS)) +
       f"SELECT arg_min(model, rmsle) AS best_model, {r('min(rmsle)')} AS best_rmsle FROM res")
def w03(spark, sf):
    _, _, res = _lb(spark, sf)
    return finish(xp.best_model(res))


@query("m28_best_model_residuals", with_(*B, *_ARMS_SQL, _res_sql(_LB_ROWS),
                                         "best AS (SELECT arg_min(model, rmsle) AS m FROM res)") +
       f"SELECT {i('row_id')} AS row_id, {r('y')} AS actual, "
       f"{r('CASE (SELECT m FROM best) WHEN ' + chr(39) + 'mean_baseline' + chr(39) + ' THEN p_mean WHEN ' + chr(39) + 'hourly_mean_baseline' + chr(39) + ' THEN p_hour ELSE p_log END')} AS pred, "
       f"{r('CASE (SELECT m FROM best) WHEN ' + chr(39) + 'mean_baseline' + chr(39) + ' THEN p_mean WHEN ' + chr(39) + 'hourly_mean_baseline' + chr(39) + ' THEN p_hour ELSE p_log END - y')} AS residual FROM pp")
def m28(spark, sf):
    """Predicted against actual for the best closed-form model (W3 + M13 keeping rows)."""
    df, preds, res = _lb(spark, sf)
    best = xp.best_model(res).first()["best_model"]
    rows = xp.holdout_rows(df, preds[best], CFG)
    return finish(rows.select("row_id", "actual", "pred", "residual"))


"""Registered queries for the learners and explanation: M6, M7, M9-M12 (learners),
M14, M16, M18, M19, M20, M21, M27, D4, W4, A7.

The ridge has an oracle throughout: SQL solves the same normal equations. Boosting has one
for rounds of depth 1 without draws. Ensembles with draws have none and get the rows-only
check; tests/test_batchfit.py holds their trees against plain recursion.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from cadence.config import LINEAR_NUMERIC, LINEAR_ONE_HOT, LINEAR_PASSTHROUGH, Config
from cadence.functions import features as fx
from cadence.operators import baselines as bl
from cadence.operators import experiments as xp
from cadence.operators import explain as ex
from cadence.operators import validate as va
from cadence.operators import correct as co
from cadence.operators.dual import dual_predictor
from cadence.operators.learners import TREE_FEATURES, BoostLog, ColumnBoostLog, LinearSpec, RidgeLog, get_model
from cadence.operators.score import make_prediction_frame
from cadence.plans.common import finish, i, r, ts
from cadence.plans.fixtures_sql import with_
from cadence.plans.q_features import CANDIDATE_CTE
from cadence.plans.q_models import HM, _base
from cadence.plans.q_splits import lab2
from cadence.plans.registry import query
from cadence.plans.ridge_sql import BACK, recursive, ridge_ctes, stump_ctes
from cadence.plans.sqlparts import fold_cte, report_sql
from cadence.session import scratch_path
from cadence.sources import io
from cadence.sources.fixtures import demand_rows, labeled, unlabeled

CFG = Config()
B = _base()


def _holdout(spark, sf, est):
    return va.holdout_predictions(va.fit_predict(est), lab2(spark, sf), CFG)


def _fitted_tree(spark, sf, name):
    """The tree model of that name at its published settings, fitted on days 1-15."""
    train = lab2(spark, sf).filter(F.dayofmonth("datetime") < 16)
    return get_model(name, CFG.params[name]).fit(train, "count")


def _eval(spark, sf, est):
    return finish(va.evaluate_holdout(va.fit_predict(est), lab2(spark, sf), CFG))


# --- M6 ridge ----------------------------------------------------------------------------------
_R1 = ["rs AS (SELECT avg(temp) AS m, stddev_pop(temp) AS s, avg(ln(1 + count)) AS my, count(*) AS n FROM tr)",
       "rc AS (SELECT covar_pop((tr.temp - rs.m) / rs.s, ln(1 + tr.count)) / (1 + 1.0::DOUBLE / rs.n) AS w, "
       "rs.m, rs.s, rs.my FROM tr CROSS JOIN rs GROUP BY rs.m, rs.s, rs.my, rs.n)"]


@query("m06_ridge_one_predictor", with_(*B, *_R1) + f"SELECT {i('row_id')} AS row_id, "
       f"{r('CASE WHEN exp(my + w * (temp - m) / s) - 1 < 0 THEN 0.0 ELSE exp(my + w * (temp - m) / s) - 1 END')} "
       "AS pred FROM ho CROSS JOIN rc")
def m06a(spark, sf):
    """Ridge (alpha 1) of log1p(count) on the population-scaled temperature: closed
    form w = cov(z, y) / (1 + alpha / n), intercept = mean(y)."""
    est = RidgeLog(1.0, LinearSpec(numeric=["temp"], passthrough=[], one_hot=[]))
    return finish(_holdout(spark, sf, est).select("row_id", "pred"))


_RID = ["trn AS (SELECT 1 AS f, row_id AS rid, * FROM tr)", "jud AS (SELECT 1 AS f, row_id AS rid, * FROM ho)"]
_RIDGE = [*_RID, *ridge_ctes("trn", "jud"), f"p AS (SELECT ho.row_id, ho.count AS y, log_pred, {BACK.format('log_pred')} AS pred FROM ho JOIN rp ON rp.rid = ho.row_id)"]


def _report(ctes):
    """Holdout report (E30 with both row counts) of the CTE ``p``."""
    return recursive(with_(*ctes)) + (f"SELECT {report_sql(with_n=False)}, CAST((SELECT count(*) FROM tr) AS BIGINT) AS n_train, "
                                      f"{i('count(*)')} AS n_holdout FROM p")


@query("m06_ridge", _report([*B, *_RIDGE]))
def m06(spark, sf):
    """Production ridge on the routed columns: holdout metrics."""
    return _eval(spark, sf, get_model("ridge", CFG.params["ridge"]))


@query("m06_ridge_predictions", recursive(with_(*B, *_RIDGE)) + f"SELECT {i('row_id')} AS row_id, {r('log_pred')} AS log_pred, {r('pred')} AS pred FROM p")
def m06p(spark, sf):
    return finish(_holdout(spark, sf, get_model("ridge", CFG.params["ridge"])).select("row_id", "log_pred", "pred"))


_CANDIDATES = [B[0], B[1], CANDIDATE_CTE, *[c.replace("f2x", "cand") for c in B[2:]]]
_EXTRA_NUM = ("feels_like_gap", "temp_humidity_interaction", "comfort_index")
_EXTRA_PASS = ("is_morning_peak", "is_evening_peak", "is_rush_hour", "bad_weather")


@query("m07_ridge_extra_columns", _report([*_CANDIDATES, *_RID, *ridge_ctes("trn", "jud", numeric=(*LINEAR_NUMERIC, *_EXTRA_NUM),
                                                                               passthrough=(*LINEAR_PASSTHROUGH, *_EXTRA_PASS)), _RIDGE[-1]]))
def m07(spark, sf):
    """Experiment ridge: candidate numerics scaled, candidate flags passed through."""
    df = fx.build_candidate_features(labeled(demand_rows(spark, sf)), CFG)
    est = get_model("ridge", CFG.params["ridge"], extra_numeric=_EXTRA_NUM, extra_passthrough=_EXTRA_PASS)
    return finish(va.evaluate_holdout(va.fit_predict(est), df, CFG))


# --- M9-M11 trees ------------------------------------------------------------------------------
@query("m09_random_forest")
def m09(spark, sf):
    return _eval(spark, sf, get_model("random_forest", CFG.params["random_forest"]))


@query("m10_gradient_boosting")
def m10(spark, sf):
    return _eval(spark, sf, get_model("gradient_boosting", CFG.params["gradient_boosting"]))


@query("m11_column_sampled_boosting")
def m11(spark, sf):
    return _eval(spark, sf, get_model("xgboost", CFG.params["xgboost"]))


STUMP_FEATURES = ("season", "workingday", "weather", "humidity", "temp", "hour", "dayofweek", "month")
STUMPS = {"n_estimators": 4, "learning_rate": 0.5, "max_depth": 1}
_STUMPS = [*_RID, *stump_ctes("trn", "jud", STUMP_FEATURES, STUMPS["n_estimators"], STUMPS["learning_rate"])]


def _stumps(spark, sf):
    train = lab2(spark, sf).filter(F.dayofmonth("datetime") < 16)
    return BoostLog(STUMP_FEATURES, **STUMPS).fit(train, "count")


@query("m10_boosted_stumps", recursive(with_(*B, *_STUMPS)) + f"SELECT {i('rid')} AS row_id, {r('log_pred')} AS log_pred, "
       f"{r(BACK.format('log_pred'))} AS pred FROM sp")
def m10s(spark, sf):
    """Four rounds of depth 1 without draws, scored on the holdout."""
    hold = lab2(spark, sf).filter(F.dayofmonth("datetime") >= 16)
    return finish(_stumps(spark, sf).predict(hold).select("row_id", "log_pred", "pred"))


_PENALISED = {"n_estimators": 3, "learning_rate": 0.7, "max_depth": 1, "reg_lambda": 50.0}


@query("m11_penalised_stumps", recursive(with_(*B, *_RID, *stump_ctes("trn", "jud", STUMP_FEATURES, 3, 0.7, penalty=50.0))) +
       f"SELECT {i('rid')} AS row_id, {r('log_pred')} AS log_pred, {r(BACK.format('log_pred'))} AS pred FROM sp")
def m11s(spark, sf):
    """The column-sampled booster's leaf penalty, at depth 1 and without draws."""
    df = lab2(spark, sf)
    fitted = ColumnBoostLog(STUMP_FEATURES, **_PENALISED).fit(df.filter(F.dayofmonth("datetime") < 16), "count")
    return finish(fitted.predict(df.filter(F.dayofmonth("datetime") >= 16)).select("row_id", "log_pred", "pred"))


@query("m21_stump_importance", recursive(with_(*B, *_STUMPS)) + " UNION ALL ".join(
    f"SELECT 'gradient_boosting' AS model, '{c}' AS feature, {r(f'(SELECT coalesce(sum(gain) FILTER (WHERE c = {chr(39)}{c}{chr(39)}), 0) / sum(gain) FROM sb)')} AS importance"
    for c in STUMP_FEATURES))
def m21s(spark, sf):
    return finish(ex.split_importance(_stumps(spark, sf), STUMP_FEATURES, spark, "gradient_boosting"))


def ridge_cv_ctes(gap: int = 0, tag: int = 0, src: str = "lab") -> list[str]:
    """The folds' training and validation rows as fits ``tag`` + fold."""
    fz = fold_cte(src, "datetime, row_id", 5, gap, name=f"fz{tag}")
    return [fz, f"tq{tag} AS (SELECT {tag} + k.f AS f, row_id AS rid, z.* FROM fz{tag} z JOIN range(1, 6) k(f) ON z.train_seg <= k.f)",
            f"vq{tag} AS (SELECT {tag} + val_fold AS f, row_id AS rid, z.* FROM fz{tag} z WHERE val_fold IS NOT NULL)"]


_CV_RIDGE = [*ridge_cv_ctes(), *ridge_ctes("tq0", "vq0"),
             f"p AS (SELECT v.f AS fold, v.count AS y, {BACK.format('log_pred')} AS pred FROM vq0 v JOIN rp ON rp.f = v.f AND rp.rid = v.rid)"]


@query("m12_cv_ridge", recursive(with_(*B, *_CV_RIDGE)) + f"SELECT {i('fold')} AS fold, {report_sql()} FROM p GROUP BY fold")
def m12r(spark, sf):
    return finish(xp.cross_validation(lab2(spark, sf), xp.Job("ridge", CFG.params["ridge"]), CFG))


@query("m12_cv_gradient_boosting")
def m12g(spark, sf):
    return finish(xp.cross_validation(lab2(spark, sf), xp.Job("gradient_boosting", CFG.params["gradient_boosting"]), CFG))


# --- M14 train job, M16 submission job, A7 -----------------------------------------------------------
def train_model_job(spark, df, name: str, cfg: Config = CFG, metrics_base: str | None = None):
    """CV + holdout, full fit, model saved, metrics upserted (keyed by model) into
    a versioned table that several jobs may write at once. Returns (model path, metrics base path, new version path)."""
    est = get_model(name, cfg.params.get(name))
    pred = va.fit_predict(est)
    cv = va.cv_report(pred, df, cfg)
    ho = va.evaluate_holdout(pred, df, cfg)
    full = est.fit(df, cfg.target)
    model_path = io.save_fitted(full, scratch_path(spark, f"model-{name}"))
    cv_long = cv.select(F.lit(name).alias("model"), F.lit("cv").alias("view"), "fold", "rmsle", "rmse", "mae", "r2")
    ho_long = ho.select(F.lit(name).alias("model"), F.lit("holdout").alias("view"), F.lit(0).alias("fold"),
                        "rmsle", "rmse", "mae", "r2")
    new = cv_long.unionByName(ho_long)
    base = metrics_base or scratch_path(spark, "metrics")
    # the metrics are settled before they are merged, so a second try fits nothing again
    rows = spark.createDataFrame(new.collect(), new.schema)
    return model_path, base, io.upsert_version(rows, base)


def _m14_ridge_sql():
    both = [*ridge_cv_ctes(), "tq AS (SELECT f, rid, * EXCLUDE (f, rid, rank, n_all, val_fold, train_seg) FROM tq0 UNION ALL SELECT 9, row_id, * FROM tr)",
            "vq AS (SELECT f, rid, * EXCLUDE (f, rid, rank, n_all, val_fold, train_seg) FROM vq0 UNION ALL SELECT 9, row_id, * FROM ho)"]
    every = [f"p AS (SELECT 'ridge' AS model, v.f, v.count AS y, {BACK.format('log_pred')} AS pred FROM vq v JOIN rp ON rp.f = v.f AND rp.rid = v.rid "
             "UNION ALL SELECT 'mean_baseline', v.f, v.count, (SELECT avg(count) FROM tq t WHERE t.f = v.f) FROM vq v)"]
    return recursive(with_(*B, *both, *ridge_ctes("tq", "vq"), *every)) + (
        f"SELECT model, CASE WHEN f = 9 THEN 'holdout' ELSE 'cv' END AS view, {i('CASE WHEN f = 9 THEN 0 ELSE f END')} AS fold, "
        f"{report_sql(with_n=False)} FROM p GROUP BY model, f")


@query("m14_train_model_job", _m14_ridge_sql())
def m14(spark, sf):
    """Two training runs into one metrics table: the second run's rows are upserted
    next to the first's (version 2 holds both models)."""
    df = lab2(spark, sf)
    _, base, _ = train_model_job(spark, df, "mean_baseline")
    _, _, latest = train_model_job(spark, df, "ridge", metrics_base=base)
    return finish(spark.read.parquet(latest))


_SUBMIT = ["trn AS (SELECT 1 AS f, row_id AS rid, * FROM lab)", "jud AS (SELECT 1 AS f, row_id AS rid, * FROM f2x WHERE day(datetime) >= 20)",
           *ridge_ctes("trn", "jud")]


@query("m16_generate_submission", recursive(with_(*B, *_SUBMIT)) + f"SELECT {ts('j.datetime')} AS datetime, {r(BACK.format('log_pred'))} AS count "
       "FROM jud j JOIN rp ON rp.rid = j.rid")
def m16(spark, sf):
    """Load the saved model, score the unlabeled rows, write the artifact,
    read it back."""
    model_path, _, _ = train_model_job(spark, lab2(spark, sf), "ridge")
    model = io.load_fitted(spark, model_path)
    test = fx.build_features(unlabeled(demand_rows(spark, sf)), CFG)
    frame = make_prediction_frame(model, test, CFG, keep_key=True)
    path = io.write_prediction_artifact(frame, scratch_path(spark, "submission"), CFG, order_key="row_id")
    return finish(io.read_prediction_artifact(spark, path, CFG))


@query("a07_model_roundtrip", recursive(with_(*B, *_RIDGE)) + f"SELECT {i('row_id')} AS row_id, {r('pred')} AS pred_fitted, {r('pred')} AS pred_loaded, "
       f"{i('1')} AS equal FROM p")
def a07(spark, sf):
    """Predictions of a saved-and-loaded ridge equal those of the fitted one."""
    df = lab2(spark, sf)
    train, hold = df.filter(F.dayofmonth("datetime") < 16), df.filter(F.dayofmonth("datetime") >= 16)
    fitted = get_model("ridge", CFG.params["ridge"]).fit(train, "count")
    path = io.save_fitted(fitted, scratch_path(spark, "a07"))
    loaded = io.load_fitted(spark, path)
    a = fitted.predict(hold).select("row_id", F.col("pred").alias("pred_fitted"))
    b = loaded.predict(hold).select("row_id", F.col("pred").alias("pred_loaded"))
    return finish(a.join(b, "row_id").withColumn("equal", (F.col("pred_fitted") == F.col("pred_loaded")).cast("int")))


@query("a07_trees_roundtrip", "SELECT m AS model, (SELECT count(*) FROM events WHERE day(ts) BETWEEN 16 AND 19) AS n, "
       "(SELECT count(*) FROM events WHERE day(ts) BETWEEN 16 AND 19) AS n_equal FROM (VALUES ('random_forest'), ('gradient_boosting'), ('xgboost')) t(m)")
def a07t(spark, sf):
    """A7 for the three tree models at their published settings: holdout rows, and those
    whose prediction is the same from the saved and loaded model."""
    df = lab2(spark, sf)
    hold = df.filter(F.dayofmonth("datetime") >= 16)
    parts = []
    for name in ("random_forest", "gradient_boosting", "xgboost"):
        fitted = _fitted_tree(spark, sf, name)
        loaded = io.load_fitted(spark, io.save_fitted(fitted, scratch_path(spark, f"a07-{name}")))
        both = loaded.predict(fitted.predict(hold, out="pred_fitted").drop("log_pred"), out="pred_loaded")
        parts.append(both.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("pred_fitted") == F.col("pred_loaded"), 1)).alias("n_equal"))
                     .select(F.lit(name).alias("model"), "n", "n_equal"))
    return finish(parts[0].unionByName(parts[1]).unionByName(parts[2]))


# --- M18, M19, M27 with learners ----------------------------------------------------------------------
_DUAL_RIDGE = [*[c.replace("1 AS f", "k.f AS f").replace("FROM tr)", "FROM tr, range(1, 3) k(f))").replace("FROM ho)", "FROM ho, range(1, 3) k(f))") for c in _RID],
               *ridge_ctes("trn", "jud", label="(CASE WHEN f = 1 THEN casual ELSE registered END)"),
               f"p AS (SELECT rid AS row_id, sum(CASE WHEN f = 1 THEN {BACK.format('log_pred')} END) AS pc, "
               f"sum(CASE WHEN f = 2 THEN {BACK.format('log_pred')} END) AS pr FROM rp GROUP BY rid)"]


@query("m18_dual_target_ridge", recursive(with_(*B, *_DUAL_RIDGE)) + f"SELECT {i('row_id')} AS row_id, {r('pc')} AS pred_casual, "
       f"{r('pr')} AS pred_registered, {r('pc + pr')} AS pred FROM p")
def m18r(spark, sf):
    """Two ridges, one a sub-target, and their sum."""
    pred = va.holdout_predictions(dual_predictor(get_model("ridge", CFG.params["ridge"]), keep_parts=True), lab2(spark, sf), CFG)
    return finish(pred.select("row_id", "pred_casual", "pred_registered", "pred"))


@query("m19_dual_target_boosting")
def m19g(spark, sf):
    """Boosted sub-target models against the direct one on the holdout."""
    df = lab2(spark, sf)
    est = get_model("gradient_boosting", CFG.params["gradient_boosting"])
    predictors = (("direct_count", va.fit_predict(est)), ("dual_target", dual_predictor(est)))
    with ThreadPoolExecutor(max_workers=2) as pool:
        arms = list(pool.map(lambda ap: va.evaluate_holdout(ap[1], df, CFG).withColumn("arm", F.lit(ap[0])), predictors))
    return finish(arms[0].unionByName(arms[1]))


@query("m27_peak_boosted_overall")
def m27g(spark, sf):
    """The smearing factor of the boosted model's training residuals, applied to the holdout."""
    theta, overall, _ = co.peak_experiment(get_model("gradient_boosting", CFG.params["gradient_boosting"]), lab2(spark, sf), CFG)
    return finish(overall.withColumn("theta", F.lit(theta)))


@query("m27_peak_boosted_by_fifth")
def m27h(spark, sf):
    _, _, by_bin = co.peak_experiment(get_model("gradient_boosting", CFG.params["gradient_boosting"]), lab2(spark, sf), CFG)
    return finish(by_bin)


# --- M20 permutation importance --------------------------------------------------------------------
PI_FEATURES = list(TREE_FEATURES)   # every column of the feature matrix
PI_REPEATS = 10


def permuted_ctes(repeats: int = PI_REPEATS, seed: int = 42) -> list[str]:
    """``pr`` (rep, row_id, other): the holdout row whose values a row gets in each repeat,
    by the same arithmetic on positions."""
    keys = "[" + ", ".join("[" + ", ".join(f"[{k}, {m}, {r % 2}]" for r, (k, m) in enumerate(rounds)) + "]"
                           for rounds in ex.round_keys(seed, repeats)) + "]::BIGINT[][][]"
    t = lambda v: f"((({v}) + k[1]) % {ex.PRIME})"
    mixed = lambda v: f"(({t(v)} * {t(v)} % {ex.PRIME} * k[2] + {t(v)}) % {ex.PRIME})"
    step = (f"lambda s, k: [CASE WHEN k[3] = 0 THEN (s[1] + {mixed('s[2]')}) % a ELSE s[1] END, "
            f"CASE WHEN k[3] = 1 THEN (s[2] + {mixed('s[1]')}) % b ELSE s[2] END, 0]")
    move = lambda x: f"list_reduce(ks, {step}, [({x}) // b, ({x}) % b, 0::BIGINT])"
    return ["pn AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM (SELECT n, arg_min(a, [CAST(a * ceil(n / a) - n AS BIGINT), a]) AS a FROM "
            f"(SELECT n, unnest(range(low, low + {ex.SIDES})) AS a FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS low FROM ho)) GROUP BY n))",
            "pp0 AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM ho)",
            f"w0 AS (SELECT rep, row_id, n, a, b, ({keys})[rep + 1] AS ks, pos AS x, true AS go FROM pp0, pn, range(0, {repeats}) t(rep))",
            f"wk AS (SELECT rep, row_id, n, a, b, ks, m[1] * b + m[2] AS x FROM (SELECT *, {move('x')} AS m FROM w0) UNION ALL "
            f"SELECT rep, row_id, n, a, b, ks, m[1] * b + m[2] FROM (SELECT *, {move('x')} AS m FROM wk WHERE x >= n))",
            "pr AS (SELECT wk.rep, pp0.row_id, wk.row_id AS other FROM wk JOIN pp0 ON pp0.pos = wk.x WHERE wk.x < wk.n)"]


def _pi_sql():
    perm = ["prs AS (SELECT pr.rep, a.count AS y, b.hour AS p_hour FROM pr JOIN ho a ON a.row_id = pr.row_id JOIN ho b ON b.row_id = pr.other)"]
    ln = "(ln(1 + CASE WHEN {p} < 0 THEN 0.0 ELSE {p} END) - ln(1 + {y}))"
    d = ln.format(p="pred", y="y")
    base = f"bs AS (SELECT sqrt(avg({d} * {d})) AS b FROM p)"
    pp = "pp AS (SELECT prs.rep, prs.y, coalesce(hm.m, gm.g) AS pred FROM prs LEFT JOIN hm ON hm.hour = prs.p_hour CROSS JOIN gm)"
    per = f"per AS (SELECT rep, sqrt(avg({d} * {d})) - (SELECT b FROM bs) AS imp FROM pp GROUP BY rep)"
    zero = " UNION ALL ".join(f"SELECT '{f}' AS feature, 0.0::DOUBLE AS importance_mean, 0.0::DOUBLE AS importance_std"
                              for f in PI_FEATURES if f != "hour")
    return recursive(with_(*B, *HM, *permuted_ctes(), *perm, base, pp, per)) + (
        f"SELECT 'hour' AS feature, {r('avg(imp)')} AS importance_mean, {r('stddev_pop(imp)')} AS importance_std "
        f"FROM per UNION ALL {zero}")


@query("m20_permutation_importance", _pi_sql())
def m20(spark, sf):
    """The hourly-mean model only reads ``hour``: its importance is the RMSLE rise when
    hours are permuted; the other 20 features, never read, score 0."""
    df = lab2(spark, sf)
    train, hold = df.filter(F.dayofmonth("datetime") < 16), df.filter(F.dayofmonth("datetime") >= 16)
    model = bl.HourlyMeanBaseline().fit(train, "count")
    imp = ex.permutation_importance(model, hold.select("row_id", "count", *PI_FEATURES), "count", PI_FEATURES,
                                    "row_id", PI_REPEATS, 42)
    return finish(imp)


def _w4_sql():
    """Permuting a column of a linear model only moves that column's term."""
    feats = [*LINEAR_NUMERIC, *LINEAR_PASSTHROUGH, *LINEAR_ONE_HOT]
    terms = ["term AS (SELECT re.rid, split_part(re.c, '=', 1) AS feature, re.x * coalesce(rw.w, 0) AS v FROM re LEFT JOIN rw ON rw.f = re.f AND rw.c = re.c)",
             *permuted_ctes(),
             f"sw AS (SELECT pr.rep, a.feature, p.y, p.log_pred - a.v + b.v AS z FROM pr JOIN term a ON a.rid = pr.row_id "
             "JOIN term b ON b.rid = pr.other AND b.feature = a.feature JOIN p ON p.row_id = pr.row_id)"]
    d = "(ln(1 + {p}) - ln(1 + y))"
    dz, d0 = d.format(p=f"({BACK.format('z')})"), d.format(p="pred")
    per = f"per AS (SELECT rep, feature, sqrt(avg({dz} * {dz})) - (SELECT sqrt(avg({d0} * {d0})) FROM p) AS imp FROM sw GROUP BY rep, feature)"
    names = ", ".join(f"'{c}'" for c in feats)
    return recursive(with_(*B, *_RIDGE, *terms, per)) + (f"SELECT feature, {r('avg(imp)')} AS importance_mean, {r('stddev_pop(imp)')} AS importance_std "
                                                         f"FROM per WHERE feature IN ({names}) GROUP BY feature")


@query("w04_importance_sorted", _w4_sql())
def w04(spark, sf):
    """Permutation importance of the ridge over every routed column, sorted."""
    df = lab2(spark, sf)
    train, hold = df.filter(F.dayofmonth("datetime") < 16), df.filter(F.dayofmonth("datetime") >= 16)
    model = get_model("ridge", CFG.params["ridge"]).fit(train, "count")
    feats = [*LINEAR_NUMERIC, *LINEAR_PASSTHROUGH, *LINEAR_ONE_HOT]
    return finish(ex.permutation_importance(model, hold, "count", feats, "row_id", PI_REPEATS, 42))


# --- M21 split importance, D4 alignment -------------------------------------------------------------
def _tree_importances(spark, sf):
    out = {}
    for name in ("random_forest", "gradient_boosting", "xgboost"):
        fitted = _fitted_tree(spark, sf, name)
        out[name] = ex.split_importance(fitted, TREE_FEATURES, spark, name)
    return out


@query("m21_split_importance")
def m21(spark, sf):
    t = _tree_importances(spark, sf)
    out = None
    for v in t.values():
        out = v if out is None else out.unionByName(v)
    return finish(out)


@query("d04_align_importances")
def d04(spark, sf):
    return finish(ex.align_by_feature(_tree_importances(spark, sf), "importance"))


D4_RATES = {"slow": 0.2, "fast": 0.9}
_D4 = [c for k, rate in D4_RATES.items() for c in stump_ctes("trn", "jud", STUMP_FEATURES, 3, rate, tag=f"_{k}")]


@query("d04_align_stump_importances", recursive(with_(*B, *_RID, *_D4)) + "SELECT feature, " + ", ".join(
    f"{r(f'coalesce(sum(g) FILTER (WHERE m = {chr(39)}{k}{chr(39)}), 0)')} AS {k}" for k in D4_RATES) + " FROM (" + " UNION ALL ".join(
    f"SELECT '{k}' AS m, c AS feature, gain / (SELECT sum(gain) FROM sb_{k}) AS g FROM sb_{k}" for k in D4_RATES) + ") GROUP BY feature")
def d04s(spark, sf):
    """Importances of a slow and a fast boosted model, aligned; features that neither
    splits on are left out."""
    train = lab2(spark, sf).filter(F.dayofmonth("datetime") < 16)
    tables = {k: ex.split_importance(BoostLog(STUMP_FEATURES, n_estimators=3, max_depth=1, learning_rate=rate).fit(train, "count"),
                                     STUMP_FEATURES, spark, "gradient_boosting").filter("importance > 0") for k, rate in D4_RATES.items()}
    return finish(ex.align_by_feature(tables, "importance"))

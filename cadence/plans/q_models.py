"""Registered queries for the baseline models and their validation (M1, M2, M12,
M13, M15, M18, M19, M24), the lookup join D1 and the metrics E4, E5, E26-E33."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import Config
from cadence.functions import features as fx
from cadence.functions import metrics as mx
from cadence.operators import baselines as bl
from cadence.operators import validate as va
from cadence.operators.dual import dual_predictor
from cadence.plans.common import finish, i, r, ts
from cadence.plans.fixtures_sql import F1, F2, feature_select, with_
from cadence.plans.q_splits import LAB, lab2
from cadence.plans.registry import query
from cadence.plans.sqlparts import fold_cte, report_sql, report_sql_raw
from cadence.sources.fixtures import demand_hourly, demand_rows, labeled, unlabeled

CFG = Config()


def lab1(spark, sf):
    """Labeled F1 hours (days 1-19) with features."""
    return fx.build_features(labeled(demand_hourly(spark, sf)), CFG)


def _base(src_cte=F2, src="f2"):
    lab = LAB.replace("f2x", f"{src}x")
    return [src_cte, feature_select(src), lab,
            "tr AS (SELECT * FROM lab WHERE day(datetime) < 16)",
            "ho AS (SELECT * FROM lab WHERE day(datetime) >= 16)"]


HM = ["hm AS (SELECT hour, avg(count) AS m FROM tr GROUP BY hour)",
      "gm AS (SELECT avg(count) AS g FROM tr)",
      "p AS (SELECT ho.*, ho.count AS y, coalesce(hm.m, gm.g) AS pred FROM ho LEFT JOIN hm USING (hour) CROSS JOIN gm)"]
MB = ["gm AS (SELECT avg(count) AS g FROM tr)",
      "p AS (SELECT ho.*, ho.count AS y, gm.g AS pred FROM ho CROSS JOIN gm)"]


def _holdout_pred(spark, sf, est, frame=None):
    df = frame if frame is not None else lab2(spark, sf)
    return va.holdout_predictions(va.fit_predict(est), df, CFG)


# --- M1, M2, D1, E4, E5 -------------------------------------------------------------------
@query("m01_mean_baseline", with_(*_base(), *MB) + f"SELECT {i('row_id')} AS row_id, {r('pred')} AS pred FROM p")
def m01(spark, sf):
    return finish(_holdout_pred(spark, sf, bl.MeanBaseline()).select("row_id", "pred"))


@query("m02_hourly_mean_baseline", with_(*_base(), *HM) +
       f"SELECT {i('row_id')} AS row_id, {i('hour')} AS hour, {r('pred')} AS pred FROM p")
def m02(spark, sf):
    return finish(_holdout_pred(spark, sf, bl.HourlyMeanBaseline()).select("row_id", "hour", "pred"))


_D1_FIT = "tr AS (SELECT * FROM lab WHERE day(datetime) < 16 AND hour BETWEEN 6 AND 20)"


@query("d01_hour_mean_lookup", with_(*[_D1_FIT if c.startswith("tr AS") else c for c in _base()], *HM) +
       f"SELECT {i('row_id')} AS row_id, {i('hour')} AS hour, {r('pred')} AS pred FROM p")
def d01(spark, sf):
    """Daytime-trained hourly means scored on all holdout hours: night hours take
    the global-mean fallback."""
    df = lab2(spark, sf)
    train = df.filter((F.dayofmonth("datetime") < 16) & F.col("hour").between(6, 20))
    hold = df.filter(F.dayofmonth("datetime") >= 16)
    pred = bl.HourlyMeanBaseline().fit(train, "count").predict(hold)
    return finish(pred.select("row_id", "hour", "pred"))


@query("e04_global_mean", with_(*_base()) + f"SELECT {r('avg(count)')} AS mean, {i('count(*)')} AS n FROM lab")
def e04(spark, sf):
    return finish(lab2(spark, sf).agg(F.avg("count").alias("mean"), F.count(F.lit(1)).alias("n")))


@query("e05_mean_per_hour", with_(*_base()) +
       f"SELECT {i('hour')} AS hour, {r('avg(count)')} AS mean, {i('count(*)')} AS n FROM lab GROUP BY hour")
def e05(spark, sf):
    return finish(bl.hour_mean_table(lab2(spark, sf), "count"))


# --- M13 and the metrics -------------------------------------------------------------------
def _m13_sql(model_ctes, src_cte=F2, src="f2"):
    return with_(*_base(src_cte, src), *model_ctes) + (
        f"SELECT {report_sql('y', 'pred', with_n=False)}, {i('(SELECT count(*) FROM tr)')} AS n_train, "
        f"{i('count(*)')} AS n_holdout FROM p")


@query("m13_holdout_hourly_mean_hourly", _m13_sql(HM, F1, "f1"))
def m13_h1(spark, sf):
    return finish(va.evaluate_holdout(va.fit_predict(bl.HourlyMeanBaseline()), lab1(spark, sf), CFG))


@query("m13_holdout_hourly_mean", _m13_sql(HM))
def m13_h2(spark, sf):
    return finish(va.evaluate_holdout(va.fit_predict(bl.HourlyMeanBaseline()), lab2(spark, sf), CFG))


@query("m13_holdout_processed_table", _m13_sql(HM))
def m13_proc(spark, sf):
    """The minimum slice on the processed table: raw rows -> prepare step (features,
    leakage drop, year/month partitions, ``day`` key) -> read back -> holdout. The
    day split is a plain predicate on ``day`` and reaches the Parquet scan."""
    from cadence.session import scratch_path
    from cadence.sources import io
    path = io.write_processed(labeled(demand_rows(spark, sf)), scratch_path(spark, "processed"), CFG)
    df = io.read_processed(spark, path)
    return finish(va.evaluate_holdout(va.fit_predict(bl.HourlyMeanBaseline()), df, CFG))


@query("m13_holdout_mean", _m13_sql(MB))
def m13_m2(spark, sf):
    return finish(va.evaluate_holdout(va.fit_predict(bl.MeanBaseline()), lab2(spark, sf), CFG))


def _metric_q(col_fn, name):
    def run(spark, sf):
        pred = _holdout_pred(spark, sf, bl.HourlyMeanBaseline())
        return finish(pred.agg(col_fn(F.col("count"), F.col("pred")).alias(name)))
    return run


_P = with_(*_base(), *HM)
query("e26_mae", _P + f"SELECT {r('avg(abs(pred - y))')} AS mae FROM p")(_metric_q(mx.mae, "mae"))
query("e27_rmse", _P + f"SELECT {r('sqrt(avg((pred - y) * (pred - y)))')} AS rmse FROM p")(_metric_q(mx.rmse, "rmse"))
query("e28_r2", _P + "SELECT r2 FROM (SELECT " + report_sql("y", "pred", False) + " FROM p)")(_metric_q(mx.r2, "r2"))
query("e29_rmsle", _P + "SELECT rmsle FROM (SELECT " + report_sql("y", "pred", False) + " FROM p)")(
    _metric_q(mx.rmsle, "rmsle"))


@query("e30_report_by_workingday", _P + f"SELECT {i('workingday')} AS workingday, {report_sql()} FROM p GROUP BY workingday")
def e30(spark, sf):
    pred = _holdout_pred(spark, sf, bl.HourlyMeanBaseline())
    return finish(mx.report(pred, "count", "pred", by=["workingday"]))


@query("b21_residual", _P + f"SELECT {i('row_id')} AS row_id, {r('pred - y')} AS residual, "
       f"{r('abs(pred - y)')} AS abs_error FROM p")
def b21(spark, sf):
    pred = _holdout_pred(spark, sf, bl.HourlyMeanBaseline())
    res = fx.residual(F.col("pred"), F.col("count"))
    return finish(pred.select("row_id", res.alias("residual"), F.abs(res).alias("abs_error")))


# --- M12 CV (one pass and refit) ---------------------------------------------------------------
def _cv_sql(by_hour: bool, gap: int = 0, src_cte=F2, src="f2", raw=False):
    fz = fold_cte("lab", "datetime, row_id", 5, gap)
    folds = (f"folds AS (SELECT f AS fold, n - (5 - f + 1) * (n // 6) - {gap} AS train_end "
             "FROM range(1, 6) t(f), (SELECT count(*) AS n FROM lab))")
    trn = "trn AS (SELECT f.fold, z.* FROM fz z JOIN folds f ON z.rank < f.train_end)"
    gm = "gm AS (SELECT fold, avg(count) AS g FROM trn GROUP BY fold)"
    if by_hour:
        hm = "hm AS (SELECT fold, hour, avg(count) AS m FROM trn GROUP BY fold, hour)"
        p = ("p AS (SELECT v.val_fold AS fold, v.count AS y, coalesce(hm.m, gm.g) AS pred FROM fz v "
             "LEFT JOIN hm ON hm.fold = v.val_fold AND hm.hour = v.hour JOIN gm ON gm.fold = v.val_fold "
             "WHERE v.val_fold IS NOT NULL)")
        ctes = [fz, folds, trn, gm, hm, p]
    else:
        p = ("p AS (SELECT v.val_fold AS fold, v.count AS y, gm.g AS pred FROM fz v "
             "JOIN gm ON gm.fold = v.val_fold WHERE v.val_fold IS NOT NULL)")
        ctes = [fz, folds, trn, gm, p]
    head = with_(src_cte, feature_select(src), LAB.replace("f2x", f"{src}x"), *ctes)
    if raw:
        return head, f"SELECT fold, {report_sql_raw()} FROM p GROUP BY fold"
    return head + f"SELECT {i('fold')} AS fold, {report_sql()} FROM p GROUP BY fold"


@query("m12_cv_hourly_mean", _cv_sql(True))
def m12_hm(spark, sf):
    return finish(va.cv_baseline_one_pass(lab2(spark, sf), True, CFG))


@query("m12_cv_hourly_mean_refit", _cv_sql(True))
def m12_hm_refit(spark, sf):
    return finish(va.cv_report(va.fit_predict(bl.HourlyMeanBaseline()), lab2(spark, sf), CFG))


@query("m12_cv_mean", _cv_sql(False))
def m12_mb(spark, sf):
    return finish(va.cv_baseline_one_pass(lab2(spark, sf), False, CFG))


@query("m12_cv_hourly_mean_hourly", _cv_sql(True, 0, F1, "f1"))
def m12_hm1(spark, sf):
    return finish(va.cv_baseline_one_pass(lab1(spark, sf), True, CFG))


def _summary_sql(head_sel):
    head, sel_ = head_sel
    aggs = ", ".join(f"{r(f'avg({m})')} AS mean_{m}, {r(f'stddev_pop({m})')} AS std_{m}" for m in mx.METRICS)
    return head + f", per_fold AS ({sel_}) SELECT {aggs}, {i('count(*)')} AS n_splits FROM per_fold"


@query("e32_fold_summary", _summary_sql(_cv_sql(True, raw=True)))
def e32(spark, sf):
    per_fold = va.cv_baseline_one_pass(lab2(spark, sf), True, CFG)
    return finish(mx.fold_summary(per_fold))


@query("e31_search_score", _cv_sql(True, raw=True)[0] +
       f", per_fold AS ({_cv_sql(True, raw=True)[1]}) SELECT {i('fold')} AS fold, {r('-rmsle')} AS score, "
       f"{i('rank() OVER (ORDER BY rmsle)')} AS rank_by_rmsle FROM per_fold")
def e31(spark, sf):
    per_fold = va.cv_baseline_one_pass(lab2(spark, sf), True, CFG)
    # five rows: a window over them is bounded by the number of folds
    from pyspark.sql import Window
    return finish(per_fold.select("fold", (-F.col("rmsle")).alias("score"),
                                  F.rank().over(Window.orderBy("rmsle")).alias("rank_by_rmsle")))


# --- M24 gap diagnostic ---------------------------------------------------------------------
def _gap_sql():
    fz = fold_cte("lab", "datetime, row_id", 5, 0)
    return with_(F2, feature_select("f2"), LAB, fz,
                 "folds AS (SELECT gp, f AS fold, n - (5 - f + 1) * (n // 6) - gp AS train_end "
                 "FROM range(1, 6) t(f), (VALUES (0), (48)) g(gp), (SELECT count(*) AS n FROM lab))",
                 "trn AS (SELECT f.gp, f.fold, z.* FROM fz z JOIN folds f ON z.rank < f.train_end)",
                 "gm AS (SELECT gp, fold, avg(count) AS g FROM trn GROUP BY gp, fold)",
                 "hm AS (SELECT gp, fold, hour, avg(count) AS m FROM trn GROUP BY gp, fold, hour)",
                 "p AS (SELECT gm.gp, v.val_fold AS fold, v.count AS y, coalesce(hm.m, gm.g) AS pred FROM fz v "
                 "JOIN gm ON gm.fold = v.val_fold LEFT JOIN hm ON hm.gp = gm.gp AND hm.fold = v.val_fold "
                 "AND hm.hour = v.hour WHERE v.val_fold IS NOT NULL)",
                 f"per AS (SELECT gp, fold, {report_sql_raw()} FROM p GROUP BY gp, fold)") + (
        f"SELECT {r('avg(rmsle) FILTER (WHERE gp = 0)')} AS cv_rmsle_gap0, "
        f"{r('avg(rmsle) FILTER (WHERE gp = 48)')} AS cv_rmsle_gap48, "
        f"{r('avg(rmsle) FILTER (WHERE gp = 48) - avg(rmsle) FILTER (WHERE gp = 0)')} AS delta FROM per")


@query("m24_gap_diagnostic", _gap_sql())
def m24(spark, sf):
    folds = va.baseline_folds(lab2(spark, sf), CFG)
    a, b = (va.cv_baseline_one_pass(None, True, CFG, gap=g, folds=folds).agg(F.avg("rmsle")).first()[0] for g in (0, 48))
    return finish(spark.createDataFrame([(a, b, b - a)], "cv_rmsle_gap0 double, cv_rmsle_gap48 double, delta double"))


# --- M15, E33: scoring the unlabeled rows ---------------------------------------------------
_UNL = ["unl AS (SELECT * FROM f2x WHERE day(datetime) >= 20)",
        "hm_all AS (SELECT hour, avg(count) AS m FROM lab GROUP BY hour)",
        "gm_all AS (SELECT avg(count) AS g FROM lab)",
        "sc AS (SELECT u.datetime, u.row_id, CASE WHEN coalesce(hm_all.m, gm_all.g) < 0 THEN 0.0 "
        "ELSE coalesce(hm_all.m, gm_all.g) END AS count FROM unl u LEFT JOIN hm_all USING (hour) CROSS JOIN gm_all)"]


def _scored(spark, sf):
    from cadence.operators.score import make_prediction_frame
    train = lab2(spark, sf)
    test = fx.build_features(unlabeled(demand_rows(spark, sf)), CFG)
    model = bl.HourlyMeanBaseline().fit(train, "count")
    return make_prediction_frame(model, test, CFG, keep_key=True)


@query("m15_prediction_frame", with_(*_base(), *_UNL) +
       f"SELECT {ts('datetime')} AS datetime, {i('row_id')} AS row_id, {r('count')} AS count FROM sc")
def m15(spark, sf):
    return finish(_scored(spark, sf))


@query("e33_prediction_range", with_(*_base(), *_UNL) +
       f"SELECT {r('min(count)')} AS min_count, {r('max(count)')} AS max_count, {i('count(*)')} AS n FROM sc")
def e33(spark, sf):
    s = _scored(spark, sf)
    return finish(s.agg(F.min("count").alias("min_count"), F.max("count").alias("max_count"),
                        F.count(F.lit(1)).alias("n")))


# --- M18, M19 dual target with the hourly mean as the model --------------------------------------
_DUAL = ["hmc AS (SELECT hour, avg(casual) AS mc, avg(registered) AS mr FROM tr GROUP BY hour)",
         "gmc AS (SELECT avg(casual) AS gc, avg(registered) AS gr FROM tr)",
         "p AS (SELECT ho.row_id, ho.count AS y, coalesce(hmc.mc, gmc.gc) AS pc, coalesce(hmc.mr, gmc.gr) AS pr, "
         "coalesce(hmc.mc, gmc.gc) + coalesce(hmc.mr, gmc.gr) AS pred FROM ho LEFT JOIN hmc USING (hour) CROSS JOIN gmc)"]


@query("m18_dual_target_predict", with_(*_base(), *_DUAL) +
       f"SELECT {i('row_id')} AS row_id, {r('pc')} AS pred_casual, {r('pr')} AS pred_registered, "
       f"{r('pred')} AS pred FROM p")
def m18(spark, sf):
    pred = va.holdout_predictions(dual_predictor(bl.HourlyMeanBaseline(), keep_parts=True), lab2(spark, sf), CFG)
    return finish(pred.select("row_id", "pred_casual", "pred_registered", "pred"))


@query("b25_sum_subpredictions", with_(*_base(), *_DUAL) +
       f"SELECT {i('row_id')} AS row_id, {r('pred')} AS pred FROM p")
def b25(spark, sf):
    pred = va.holdout_predictions(dual_predictor(bl.HourlyMeanBaseline()), lab2(spark, sf), CFG)
    return finish(pred.select("row_id", "pred"))


def _dual_sql():
    fz = fold_cte("lab", "datetime, row_id", 5, 0)
    return with_(*_base(), fz,
                 "folds AS (SELECT f AS fold, n - (5 - f + 1) * (n // 6) AS train_end "
                 "FROM range(1, 6) t(f), (SELECT count(*) AS n FROM lab))",
                 "trn AS (SELECT f.fold, z.* FROM fz z JOIN folds f ON z.rank < f.train_end)",
                 "gm AS (SELECT fold, avg(casual) AS gc, avg(registered) AS gr FROM trn GROUP BY fold)",
                 "hm AS (SELECT fold, hour, avg(casual) AS mc, avg(registered) AS mr FROM trn GROUP BY fold, hour)",
                 "cp AS (SELECT v.val_fold AS fold, v.count AS y, coalesce(hm.mc, gm.gc) + coalesce(hm.mr, gm.gr) "
                 "AS pred FROM fz v JOIN gm ON gm.fold = v.val_fold LEFT JOIN hm ON hm.fold = v.val_fold "
                 "AND hm.hour = v.hour WHERE v.val_fold IS NOT NULL)", *_DUAL) + (
        f"SELECT 'cv' AS view, {i('fold')} AS fold, {report_sql()} FROM cp GROUP BY fold "
        f"UNION ALL SELECT 'holdout' AS view, CAST(0 AS BIGINT) AS fold, {report_sql()} FROM p")


@query("m19_dual_target_evaluate", _dual_sql())
def m19(spark, sf):
    df = lab2(spark, sf)
    pred_fn = dual_predictor(bl.HourlyMeanBaseline())
    # all five folds of both sub-target models in one scan
    cv = va.cv_baseline_one_pass(df, True, CFG, labels=["casual", "registered"]).withColumn("view", F.lit("cv"))
    hold = mx.report(va.holdout_predictions(pred_fn, df, CFG), "count", "pred").withColumn(
        "view", F.lit("holdout")).withColumn("fold", F.lit(0))
    return finish(cv.unionByName(hold).select("view", "fold", "rmsle", "rmse", "mae", "r2", "n"))

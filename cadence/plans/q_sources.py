"""Registered queries for sources and sinks: A1-A6, A8-A10. Each writes through the
library's writer into the shared scratch folder and returns what its reader reads
back, so the oracle checks the round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import Config
from cadence.functions import features as fx
from cadence.operators import baselines as bl
from cadence.operators import validate as va
from cadence.operators.dual import dual_predictor
from cadence.operators.score import make_prediction_frame
from cadence.operators.splits import split_holdout
from cadence.plans.common import finish, i, r, ts
from cadence.plans.fixtures_sql import F2, feature_select, with_
from cadence.plans.q_features import F2_COLS, FEATS, sel
from cadence.plans.q_learners import train_model_job
from cadence.plans.q_models import HM, _UNL, _base, _gap_sql
from cadence.plans.q_splits import LAB, lab2
from cadence.plans.q_profile import TEST
from cadence.plans.registry import query
from cadence.plans.sqlparts import fold_cte, report_sql_raw
from cadence.session import scratch_path
from cadence.sources import io
from cadence.sources.fixtures import demand_rows, labeled, unlabeled

CFG = Config()
B = _base()
METRICS = ("rmsle", "rmse", "mae", "r2")


# --- A1-A4 --------------------------------------------------------------------------------------
@query("a01_read_raw_csv", with_(F2, feature_select("f2"), LAB) + f"SELECT {sel(F2_COLS)} FROM lab")
def a01(spark, sf):
    path = io.write_raw_csv(labeled(demand_rows(spark, sf)), scratch_path(spark, "raw-train"))
    return finish(io.read_raw_csv(spark, path))


_UNLABELED = [f.name for f in io.UNLABELED_SCHEMA]


@query("a01_read_raw_csv_unlabeled", with_(F2, feature_select("f2"), TEST) + f"SELECT {sel(_UNLABELED)} FROM tst")
def a01u(spark, sf):
    """The raw file without counts, by its own schema."""
    rows = unlabeled(demand_rows(spark, sf), drop=("casual", "registered", "count"))
    path = io.write_raw_csv(rows, scratch_path(spark, "raw-test"), io.UNLABELED_SCHEMA)
    return finish(io.read_raw_csv(spark, path, io.UNLABELED_SCHEMA))


_PROC = [c for c in F2_COLS + FEATS if c not in ("casual", "registered")]


def _processed(spark, sf):
    path = io.write_processed(io.read_raw_csv(spark, io.write_raw_csv(labeled(demand_rows(spark, sf)),
                                                                    scratch_path(spark, "raw"))),
                              scratch_path(spark, "processed"), CFG)
    return path


@query("a02_write_processed", with_(F2, feature_select("f2"), LAB) + f"SELECT {sel(_PROC)} FROM lab")
def a02(spark, sf):
    """Raw CSV -> features -> leakage drop -> Parquet partitioned by year/month."""
    return finish(spark.read.parquet(_processed(spark, sf)).select(*_PROC))


@query("a03_read_processed", with_(F2, feature_select("f2"), LAB) + f"SELECT {sel(_PROC)} FROM lab")
def a03(spark, sf):
    return finish(io.read_processed(spark, _processed(spark, sf)).select(*_PROC))


def _submission(spark, sf, model):
    """The unlabeled rows scored, written as the artifact and read back."""
    test = fx.build_features(unlabeled(demand_rows(spark, sf)), CFG)
    frame = make_prediction_frame(model, test, CFG, keep_key=True)
    path = io.write_prediction_artifact(frame, scratch_path(spark, "submission"), CFG, order_key="row_id")
    return io.read_prediction_artifact(spark, path, CFG)


@query("a04_prediction_sink", with_(*B, *_UNL) + f"SELECT {ts('datetime')} AS datetime, {r('count')} AS count FROM sc")
def a04(spark, sf):
    """The prediction artifact of a fitted hourly mean, written and read back."""
    return finish(_submission(spark, sf, bl.HourlyMeanBaseline().fit(lab2(spark, sf), "count")))


@query("m16_submission_hourly_mean", with_(*B, *_UNL) + f"SELECT {ts('datetime')} AS datetime, {r('count')} AS count FROM sc")
def m16_hm(spark, sf):
    """M16 with the hourly mean: train job, saved model loaded, artifact written and read."""
    path, _, _ = train_model_job(spark, lab2(spark, sf), "hourly_mean_baseline")
    return finish(_submission(spark, sf, io.load_fitted(spark, path)))


@query("a07_baseline_roundtrip", with_(*B, *HM) + f"SELECT {i('row_id')} AS row_id, {r('pred')} AS pred FROM p")
def a07_hm(spark, sf):
    """Holdout predictions of an hourly mean that was saved and loaded."""
    train, hold = split_holdout(lab2(spark, sf), CFG)
    path = io.save_fitted(bl.HourlyMeanBaseline().fit(train, "count"), scratch_path(spark, "a07-hm"))
    return finish(io.load_fitted(spark, path).predict(hold).select("row_id", "pred"))


# --- A5 upsert, A6 record ----------------------------------------------------------------------------
_A5 = ["hm AS (SELECT hour, avg(count) AS m, avg(casual) AS mc, avg(registered) AS mr FROM tr GROUP BY hour)",
       "gm AS (SELECT avg(count) AS g, avg(casual) AS gc, avg(registered) AS gr FROM tr)",
       "pp AS (SELECT ho.count AS y, gm.g AS p_mean, coalesce(hm.mc, gm.gc) + coalesce(hm.mr, gm.gr) AS p_dual "
       "FROM ho LEFT JOIN hm USING (hour) CROSS JOIN gm)"]


@query("a05_metrics_upsert", with_(*B, *_A5, (
    f"res AS (SELECT 'mean_baseline' AS model, 'direct_count' AS arm, {report_sql_raw('y', 'p_mean')} FROM pp "
    f"UNION ALL SELECT 'hourly_mean_baseline', 'dual_target', {report_sql_raw('y', 'p_dual')} FROM pp)")) +
    "SELECT model, arm, " + ", ".join(f"{r(m)} AS {m}" for m in METRICS) + f", {i('n')} AS n FROM res")
def a05(spark, sf):
    """Version 1 holds both baselines; the dual-target run replaces the hourly-mean
    row (anti-join on the key + union) and is written as version 2."""
    df = lab2(spark, sf)
    rows = []
    for name, arm, pred in (("mean_baseline", "direct_count", va.fit_predict(bl.MeanBaseline())),
                            ("hourly_mean_baseline", "direct_count", va.fit_predict(bl.HourlyMeanBaseline())),
                            ("hourly_mean_baseline", "dual_target", dual_predictor(bl.HourlyMeanBaseline()))):
        rows.append(va.evaluate_holdout(pred, df, CFG).select(F.lit(name).alias("model"), F.lit(arm).alias("arm"),
                                                               *METRICS, F.col("n_holdout").alias("n")))
    base = scratch_path(spark, "metrics")
    v1 = io.write_version(rows[0].unionByName(rows[1]), base, 1)
    v2 = io.write_version(io.upsert(spark.read.parquet(v1), rows[2], ("model",)), base, 2)
    return finish(spark.read.parquet(v2))


@query("a06_experiment_record", _gap_sql().replace(" AS delta FROM per", " AS delta, CAST(1 AS BIGINT) AS "
                                                    "refused_overwrite FROM per"))
def a06(spark, sf):
    """The gap-diagnostic record is saved once; a second save without ``force`` is
    refused (FileExistsError) and the stored record is unchanged."""
    folds = va.baseline_folds(lab2(spark, sf), CFG)
    a, b = (va.cv_baseline_one_pass(None, True, CFG, gap=g, folds=folds).agg(F.avg("rmsle")).first()[0] for g in (0, 48))
    rec = spark.createDataFrame([(a, b, b - a)], "cv_rmsle_gap0 double, cv_rmsle_gap48 double, delta double")
    path = io.save_record(rec, scratch_path(spark, "gap-record"))
    refused = 0
    try:
        io.save_record(rec.withColumn("delta", F.lit(0.0)), path)
    except FileExistsError:
        refused = 1
    return finish(spark.read.parquet(path).withColumn("refused_overwrite", F.lit(refused)))


# --- A8-A10 nested documents ---------------------------------------------------------------------------
def _docs(spark, sf):
    df = lab2(spark, sf)
    folds = va.baseline_folds(df, CFG)
    docs = None
    for name, by_hour, est in (("mean_baseline", False, bl.MeanBaseline()),
                               ("hourly_mean_baseline", True, bl.HourlyMeanBaseline())):
        per_fold = va.cv_baseline_one_pass(None, by_hour, CFG, folds=folds)
        ho = va.evaluate_holdout(va.fit_predict(est), df, CFG)
        d = io.metrics_document(name, per_fold, ho)
        docs = d if docs is None else docs.unionByName(d)
    path = io.write_metrics_report(docs, scratch_path(spark, "metrics-json"))
    return io.read_metrics_report(spark, path)


def _cv2_sql():
    fz = fold_cte("lab", "datetime, row_id", 5, 0)
    return [fz,
            "folds AS (SELECT f AS fold, n - (5 - f + 1) * (n // 6) AS train_end FROM range(1, 6) t(f), "
            "(SELECT count(*) AS n FROM lab))",
            "trn AS (SELECT f.fold, z.* FROM fz z JOIN folds f ON z.rank < f.train_end)",
            "cgm AS (SELECT fold, avg(count) AS g FROM trn GROUP BY fold)",
            "chm AS (SELECT fold, hour, avg(count) AS m FROM trn GROUP BY fold, hour)",
            "pv AS (SELECT v.val_fold AS fold, v.count AS y, cgm.g AS p_mean, coalesce(chm.m, cgm.g) AS p_hour "
            "FROM fz v JOIN cgm ON cgm.fold = v.val_fold LEFT JOIN chm ON chm.fold = v.val_fold AND chm.hour = v.hour "
            "WHERE v.val_fold IS NOT NULL)",
            f"pf AS (SELECT 'mean_baseline' AS model, fold, {report_sql_raw('y', 'p_mean')} FROM pv GROUP BY fold "
            f"UNION ALL SELECT 'hourly_mean_baseline', fold, {report_sql_raw('y', 'p_hour')} FROM pv GROUP BY fold)",
            "hgm AS (SELECT avg(count) AS g FROM tr)",
            "hhm AS (SELECT hour, avg(count) AS m FROM tr GROUP BY hour)",
            "hp AS (SELECT ho.count AS y, hgm.g AS p_mean, coalesce(hhm.m, hgm.g) AS p_hour FROM ho "
            "LEFT JOIN hhm USING (hour) CROSS JOIN hgm)",
            f"hf AS (SELECT 'mean_baseline' AS model, {report_sql_raw('y', 'p_mean')} FROM hp "
            f"UNION ALL SELECT 'hourly_mean_baseline', {report_sql_raw('y', 'p_hour')} FROM hp)"]


def _a08_sql():
    parts = []
    for m in METRICS:
        parts.append(f"SELECT model, 'cv' AS view, 'mean' AS stat, '{m}' AS metric, avg({m}) AS value FROM pf GROUP BY model")
        parts.append(f"SELECT model, 'cv', 'std', '{m}', stddev_pop({m}) FROM pf GROUP BY model")
        parts.append(f"SELECT model, 'holdout', 'value', '{m}', {m} FROM hf")
    return with_(*B, *_cv2_sql(), "fl AS (" + " UNION ALL ".join(parts) + ")") + (
        f"SELECT model, view, stat, metric, {r('value')} AS value FROM fl")


@query("a08_metrics_json_flat", _a08_sql())
def a08(spark, sf):
    return finish(io.flatten_metrics(_docs(spark, sf)))


@query("a09_fold_records", with_(*B, *_cv2_sql()) + " UNION ALL ".join(
    f"SELECT model, {i('fold')} AS fold, '{m}' AS metric, {r(m)} AS value FROM pf" for m in METRICS))
def a09(spark, sf):
    return finish(io.fold_records(_docs(spark, sf)))


def _a10_sql():
    fz = fold_cte("lab", "datetime, row_id", 5, 0)
    return with_(F2, feature_select("f2"), LAB, fz,
                 "folds AS (SELECT gp, f AS fold, n - (5 - f + 1) * (n // 6) - gp AS train_end "
                 "FROM range(1, 6) t(f), (VALUES (0), (48)) g(gp), (SELECT count(*) AS n FROM lab))",
                 "trn AS (SELECT f.gp, f.fold, z.* FROM fz z JOIN folds f ON z.rank < f.train_end)",
                 "gm AS (SELECT gp, fold, avg(count) AS g FROM trn GROUP BY gp, fold)",
                 "hm AS (SELECT gp, fold, hour, avg(count) AS m FROM trn GROUP BY gp, fold, hour)",
                 "p AS (SELECT gm.gp, v.val_fold AS fold, v.count AS y, gm.g AS p_mean, coalesce(hm.m, gm.g) AS p_hour "
                 "FROM fz v JOIN gm ON gm.fold = v.val_fold LEFT JOIN hm ON hm.gp = gm.gp AND hm.fold = v.val_fold "
                 "AND hm.hour = v.hour WHERE v.val_fold IS NOT NULL)",
                 f"per AS (SELECT 'mean_baseline' AS model, gp, fold, {report_sql_raw('y', 'p_mean')} FROM p GROUP BY gp, fold "
                 f"UNION ALL SELECT 'hourly_mean_baseline', gp, fold, {report_sql_raw('y', 'p_hour')} FROM p GROUP BY gp, fold)",
                 "cv AS (SELECT model, gp, avg(rmsle) AS cv_rmsle FROM per GROUP BY model, gp)") + (
        f"SELECT a.model, {i('a.gp')} AS gap, {r('a.cv_rmsle')} AS cv_rmsle, {r('a.cv_rmsle - b.cv_rmsle')} AS delta "
        "FROM cv a JOIN cv b ON a.model = b.model AND b.gp = 0")


@query("a10_sweep_flat", _a10_sql())
def a10(spark, sf):
    """CV means of both baselines at gap 0 and 48, written as the gap-diagnostic
    document, read back and turned into (model, gap, cv_rmsle, delta)."""
    folds = va.baseline_folds(lab2(spark, sf), CFG)
    parts = []
    for name, by_hour in (("mean_baseline", False), ("hourly_mean_baseline", True)):
        for gap in (0, 48):
            per_fold = va.cv_baseline_one_pass(None, by_hour, CFG, gap=gap, folds=folds)
            parts.append(per_fold.agg(*[F.avg(m).alias(m) for m in METRICS])
                         .select(F.lit(name).alias("model"), F.lit(gap).alias("gap"), *METRICS))
    per_gap = parts[0]
    for p in parts[1:]:
        per_gap = per_gap.unionByName(p)
    path = io.write_gap_report(per_gap, scratch_path(spark, "gap-json"))
    return finish(io.sweep_long(io.read_gap_report(spark, path)))


# --- M14 with closed-form models -------------------------------------------------------------------
def _m14_sql():
    cols = ", ".join(f"{r(m)} AS {m}" for m in METRICS)
    return with_(*B, *_cv2_sql()) + (f"SELECT model, 'cv' AS view, {i('fold')} AS fold, {cols} FROM pf "
                                     f"UNION ALL SELECT model, 'holdout', {i('0')}, {cols} FROM hf")


@query("m14_train_job_baselines", _m14_sql())
def m14_hm(spark, sf):
    """Training runs of both baselines, and the first again, into one metrics table: a
    rerun replaces its model's rows (version 3 holds each model once)."""
    df, base = lab2(spark, sf), None
    for name in ("mean_baseline", "hourly_mean_baseline", "mean_baseline"):
        _, base, latest = train_model_job(spark, df, name, metrics_base=base)
    return finish(spark.read.parquet(latest))


# --- M32 train/test predictor schema equality ------------------------------------------------------
def schema_diff(train, test, exclude=("count", "casual", "registered")):
    """One row per predictor column of either table with both types and a flag;
    the predictor sets must agree (``same`` = 1 everywhere)."""
    spark = train.sparkSession
    a = {f.name: f.dataType.simpleString() for f in train.schema.fields if f.name not in exclude}
    b = {f.name: f.dataType.simpleString() for f in test.schema.fields if f.name not in exclude}
    rows = [(c, a.get(c), b.get(c), int(a.get(c) == b.get(c))) for c in sorted(set(a) | set(b))]
    return spark.createDataFrame(rows, "column_name string, train_type string, test_type string, same int")


#: Types of the processed predictors, as the prepare step declares them.
_KINDS = {"timestamp_ntz": ["datetime"], "bigint": ["row_id"], "tinyint": ["day", "is_weekend"],
          "smallint": ["year", "month", "dayofweek", "hour"], "int": ["season", "holiday", "workingday", "weather"],
          "double": ["temp", "atemp", "humidity", "windspeed"],
          "float": ["hour_sin", "hour_cos", "hour_sin2", "hour_cos2", "month_sin", "month_cos", "hour_sin_workday",
                    "hour_cos_workday"]}


@query("m32_schema_equality", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{kind}' AS train_type, '{kind}' AS test_type, {i('1')} AS same"
    for kind, names in _KINDS.items() for c in names))
def m32(spark, sf):
    """Processed train (days 1-19, leakage dropped) and processed test (days 20+)
    written through the same prepare step; their predictor schemas are compared."""
    raw = demand_rows(spark, sf)
    tr = io.read_processed(spark, io.write_processed(labeled(raw), scratch_path(spark, "proc-train"), CFG))
    te = io.read_processed(spark, io.write_processed(unlabeled(raw), scratch_path(spark, "proc-test"), CFG,
                                                     labeled=False))
    return finish(schema_diff(tr, te))

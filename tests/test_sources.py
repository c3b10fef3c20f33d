"""Source and sink contracts: clear errors, schema checks, round trips."""
import pytest
from pyspark.sql import functions as F

from cadence.sources import io
from cadence.sources.fixtures import demand_rows, labeled

from .conftest import SF001


def test_missing_raw_file_raises_with_instructions(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no raw CSV"):
        io.read_raw_csv(spark, str(tmp_path / "nope.csv"))


def test_missing_processed_table_says_run_prepare(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no processed table"):
        io.read_processed(spark, str(tmp_path / "nope"))


def test_prediction_artifact_requires_exact_columns(spark, tmp_path):
    df = spark.createDataFrame([(1.0,)], "count double")
    with pytest.raises(ValueError, match="datetime"):
        io.write_prediction_artifact(df, str(tmp_path / "p"))


def test_csv_round_trip_keeps_microseconds(spark, tmp_path):
    df = labeled(demand_rows(spark, SF001))
    back = io.read_raw_csv(spark, io.write_raw_csv(df, str(tmp_path / "raw")))
    assert df.select(*back.columns).exceptAll(back).count() == 0


def test_record_refuses_overwrite_unless_forced(spark, tmp_path):
    rec = spark.createDataFrame([(1.0,)], "v double")
    path = io.save_record(rec, str(tmp_path / "rec"))
    with pytest.raises(FileExistsError):
        io.save_record(rec, path)
    io.save_record(rec.withColumn("v", F.lit(2.0)), path, force=True)
    assert spark.read.parquet(path).first()["v"] == 2.0


def test_upsert_replaces_by_key(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "model string, rmsle double")
    new = spark.createDataFrame([("b", 3.0), ("c", 4.0)], "model string, rmsle double")
    got = {r["model"]: r["rmsle"] for r in io.upsert(old, new).collect()}
    assert got == {"a": 1.0, "b": 3.0, "c": 4.0}


def test_metrics_report_layout_round_trip(spark, tmp_path):
    import glob
    import json
    per_fold = spark.createDataFrame([(f, 0.1 * f, 1.0, 1.0, 0.5) for f in range(1, 6)],
                                     "fold int, rmsle double, rmse double, mae double, r2 double")
    ho = spark.createDataFrame([(0.3, 2.0, 1.0, 0.9, 80, 20)],
                               "rmsle double, rmse double, mae double, r2 double, n_train long, n_holdout long")
    doc = io.metrics_document("m", per_fold, ho)
    path = io.write_metrics_report(doc, str(tmp_path / "metrics"))
    text = [open(f).read() for f in glob.glob(path + "/part-*") if open(f).read().strip()]
    j = json.loads(text[0])
    assert list(j["m"]) == ["cv", "day_of_month_holdout"] and len(j["m"]["cv"]["folds"]) == 5
    back = io.read_metrics_report(spark, path)
    flat = {(r["view"], r["stat"], r["metric"]): r["value"] for r in io.flatten_metrics(back).collect()}
    assert flat[("cv", "mean", "rmsle")] == pytest.approx(0.3) and flat[("holdout", "value", "r2")] == 0.9
    folds = {(r["fold"], r["metric"]): r["value"] for r in io.fold_records(back).collect()}
    assert folds[(5, "rmsle")] == pytest.approx(0.5)


def test_read_gap_record_layout(spark, tmp_path):
    doc = ('{"gaps": [0, 48], "models": {"ridge": {"by_gap": {'
           '"0": {"rmsle": 0.8064, "rmse": 157.8152, "mae": 104.1994, "r2": 0.219}, '
           '"48": {"rmsle": 0.9542, "rmse": 171.8167, "mae": 115.0877, "r2": 0.0337}}, '
           '"cv_rmsle_delta_gap48_minus_gap0": 0.1478}}}')
    (tmp_path / "gap").mkdir()
    (tmp_path / "gap" / "record.json").write_text(doc)
    rows = {r["gap"]: r for r in io.sweep_long(io.read_gap_report(spark, str(tmp_path / "gap"))).collect()}
    assert rows[0]["cv_rmsle"] == 0.8064 and rows[48]["delta"] == pytest.approx(0.1478)


def test_processed_table_is_checked_against_the_prepare_step(spark, tmp_path):
    path = str(tmp_path / "other")
    spark.range(3).selectExpr("id AS humidity", "2011 AS year", "1 AS month").write.parquet(path)
    with pytest.raises(ValueError, match="humidity .bigint, not double."):
        io.read_processed(spark, path)
    own = io.read_processed(spark, path, spark.read.parquet(path).schema)
    assert own.count() == 3


def test_concurrent_jobs_lose_no_rows(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    base = str(tmp_path / "metrics")
    jobs = [spark.createDataFrame([(f"model{k % 4}", float(k))], "model string, rmsle double") for k in range(8)]
    with ThreadPoolExecutor(8) as pool:
        paths = list(pool.map(lambda df: io.upsert_version(df, base), jobs))
    assert len(set(paths)) == 8 and io.latest_version(spark, base) == 8
    rows = spark.read.parquet(f"{base}/v0008").collect()
    assert sorted(r["model"] for r in rows) == [f"model{k}" for k in range(4)]   # each model once, from its last job
    last = {f"model{k}": max((p, j) for j, p in enumerate(paths) if j % 4 == k)[1] for k in range(4)}
    assert {r["model"]: r["rmsle"] for r in rows} == {m: float(j) for m, j in last.items()}
    with pytest.raises(FileExistsError):
        io.write_version(jobs[0], base, 3)


def test_saved_trees_predict_the_same(spark, tmp_path):
    from cadence.operators.learners import get_model
    df = spark.createDataFrame([(i, float(i % 7), float(i % 11), float(i % 13)) for i in range(300)], "row_id bigint, a double, b double, count double")
    for name, params in (("random_forest", {"n_estimators": 7}), ("gradient_boosting", {"n_estimators": 9}), ("xgboost", {"n_estimators": 5})):
        est = get_model(name, params)
        est.features = ["a", "b"]
        fitted = est.fit(df, "count")
        loaded = io.load_fitted(spark, io.save_fitted(fitted, str(tmp_path / name)))
        a, b = ([r["pred"] for r in m.predict(df).orderBy("row_id").collect()] for m in (fitted, loaded))
        assert a == b and len(set(a)) > 5

"""Readers and writers (A1-A10).

All paths go through Hadoop's FileSystem, so the same code works on a local disk,
HDFS or an object store. Writes are distributed (one file per task); nothing is
funnelled into a single output file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.config import Config
from cadence.functions.features import build_features, drop_leakage_columns

RAW_SCHEMA = T.StructType([
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("row_id", T.LongType()),
    T.StructField("season", T.IntegerType()),
    T.StructField("holiday", T.IntegerType()),
    T.StructField("workingday", T.IntegerType()),
    T.StructField("weather", T.IntegerType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("atemp", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("windspeed", T.DoubleType()),
    T.StructField("casual", T.DoubleType()),
    T.StructField("registered", T.DoubleType()),
    T.StructField("count", T.DoubleType()),
])
UNLABELED_SCHEMA = T.StructType([f for f in RAW_SCHEMA.fields if f.name not in ("casual", "registered", "count")])


# Full microsecond precision; Spark's CSV default keeps milliseconds only.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


# --- A1 ------------------------------------------------------------------------------------
def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """A1: CSV with a header and an explicit schema (datetime parsed as timestamp_ntz)."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no raw CSV at {path} (its header: {','.join(schema.fieldNames())})")
    # enforceSchema=false: the header names are checked against the schema instead
    # of binding columns by position.
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").option("timestampNTZFormat", TS_FORMAT).csv(path))


def write_raw_csv(df: DataFrame, path: str, schema: T.StructType = RAW_SCHEMA) -> str:
    cols = [c for c in schema.fieldNames() if c in df.columns]
    (df.select(*cols).write.mode("overwrite").option("header", True).option("timestampNTZFormat", TS_FORMAT)
     .csv(path))
    return path


# --- A2, A3 ----------------------------------------------------------------------------------
def write_processed(df: DataFrame, path: str, cfg: Config = Config(), labeled: bool = True) -> str:
    """A2: features -> leakage drop -> Parquet partitioned by year and month.

    A ``day`` key column (never a feature) is stored and the rows are range-
    partitioned and sorted by (year, month, day, datetime, key): each task writes a
    contiguous slice, so files stay few and every row group covers a narrow day
    range - the day-of-month split then becomes a pushed-down Parquet filter that
    skips row groups (``dayofmonth(datetime)`` itself cannot be pushed down)."""
    out = build_features(df, cfg).withColumn("day", F.dayofmonth(cfg.datetime_col).cast("byte"))
    if labeled:
        out = drop_leakage_columns(out, cfg)
    order = ["year", "month", "day", *cfg.order_cols]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (out.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .write.mode("overwrite").partitionBy("year", "month").parquet(path))
    return path


def check_processed(df: DataFrame, cfg: Config = Config()) -> None:
    """Every predictor that the prepare step makes of raw rows, and ``day``, must be
    there with its type (labels, keys and further columns are free)."""
    made = build_features(df.sparkSession.createDataFrame([], UNLABELED_SCHEMA), cfg).withColumn(
        "day", F.dayofmonth(cfg.datetime_col).cast("byte"))
    kinds = {f.name: f.dataType for f in df.schema}
    keys = set(cfg.order_cols) - {cfg.datetime_col}
    wrong = [f"{f.name} ({kinds[f.name].simpleString() if f.name in kinds else 'absent'}, not {f.dataType.simpleString()})"
             for f in made.schema if f.name not in keys and kinds.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"not a processed table: {', '.join(wrong)}")


def read_processed(spark: SparkSession, path: str, schema: T.StructType | None = None, cfg: Config = Config()) -> DataFrame:
    """A3: read the processed table; partition columns keep their declared types. Without
    a schema of the caller's, the table must hold what ``write_processed`` makes."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no processed table at {path}; write_processed makes it")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    df = df.withColumns({c: F.col(c).cast("short") for c in ("year", "month") if c in df.columns})
    if schema is None:
        check_processed(df, cfg)
    return df


# --- A4 ----------------------------------------------------------------------------------------
def write_prediction_artifact(frame: DataFrame, path: str, cfg: Config = Config(), order_key: str | None = None) -> str:
    """A4: exactly ``[datetime, count]`` (optionally with the row key used for the
    order, dropped before writing), CSV with a header; range-partitioned by time
    so the shards are ordered, never coalesced into one file."""
    expected = [cfg.datetime_col, cfg.target]
    cols = [c for c in frame.columns if c != order_key]
    if cols != expected:
        raise ValueError(f"a prediction artifact holds {expected}, not {cols}")
    order = [cfg.datetime_col] + ([order_key] if order_key else [])
    n = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (frame.repartitionByRange(n, *order).sortWithinPartitions(*order).select(*expected)
     .write.mode("overwrite").option("header", True).option("timestampNTZFormat", TS_FORMAT).csv(path))
    return path


def read_prediction_artifact(spark: SparkSession, path: str, cfg: Config = Config()) -> DataFrame:
    schema = T.StructType([T.StructField(cfg.datetime_col, T.TimestampNTZType()),
                           T.StructField(cfg.target, T.DoubleType())])
    return spark.read.schema(schema).option("header", True).option("timestampNTZFormat", TS_FORMAT).csv(path)


# --- A5, A6 --------------------------------------------------------------------------------------
def upsert(existing: DataFrame, new: DataFrame, keys=("model",)) -> DataFrame:
    """A5: rows of ``existing`` whose key is not in ``new``, plus all of ``new``."""
    keep = existing.join(new.select(*keys), list(keys), "left_anti")
    return keep.unionByName(new)


def _publish(spark: SparkSession, staged: str, path: str) -> bool:
    """Moves a written folder to a name that must still be free; False if it is taken.
    The file system decides, so of two jobs that publish one name only one does."""
    jvm = spark.sparkContext._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        files.rename(src, dst, options)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception) or path_exists(spark, path):
            return False
        raise
    return True


def write_version(df: DataFrame, base: str, version: int) -> str:
    """A version as a folder of its own, which readers of older ones never see change. It
    appears whole or not at all; a version that stands already is an error."""
    path, staged = f"{base.rstrip('/')}/v{version:04d}", f"{base.rstrip('/')}/_staged/{uuid.uuid4().hex}"
    df.write.parquet(staged)
    if not _publish(df.sparkSession, staged, path):
        raise FileExistsError(f"version {version} stands at {path}")
    return path


def latest_version(spark: SparkSession, base: str) -> int:
    """Number of the newest version; 0: none. Versions are numbered without gaps."""
    have = lambda v: path_exists(spark, f"{base.rstrip('/')}/v{v:04d}")
    high = 1
    while have(high):
        high *= 2
    low = high // 2
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if have(mid) else (low, mid)
    return low


def upsert_version(new: DataFrame, base: str, keys: Sequence[str] = ("model",), tries: int = 100) -> str:
    """A5 for several jobs at once: merges ``new`` into the newest version and publishes
    the next one. A job that finds that version taken meanwhile reads it and merges
    again, so no job's rows are lost."""
    spark = new.sparkSession
    for _ in range(tries):
        version = latest_version(spark, base)
        merged = upsert(spark.read.parquet(f"{base.rstrip('/')}/v{version:04d}"), new, keys) if version else new
        try:
            return write_version(merged, base, version + 1)
        except FileExistsError:
            continue
    raise RuntimeError(f"{tries} versions of {base} were published by others before this one")


def save_record(df: DataFrame, path: str, force: bool = False) -> str:
    """An experiment record refuses to overwrite an existing one unless forced."""
    if not force and path_exists(df.sparkSession, path):
        raise FileExistsError(f"a record stands at {path}; force=True replaces it")
    df.write.mode("overwrite" if force else "errorifexists").parquet(path)
    return path


# --- A7 model persistence ------------------------------------------------------------------------
def save_fitted(fitted, path: str) -> str:
    """A fitted model. Baselines and linear models are a few numbers in a one-row
    table; trees are a table of one row a tree plus the bins' edges and settings."""
    from dataclasses import asdict

    from cadence.operators import batchfit
    from cadence.operators.learners import ForestFitted, LinearFitted, TreesFitted
    spark = SparkSession.getActiveSession()
    means = getattr(fitted, "hour_means_", None)
    if means is not None or hasattr(fitted, "mean_"):  # a baseline: at most 24 numbers
        meta = {"kind": "hourly_mean", "mean": fitted.global_mean_, "hours": {r[0]: r[1] for r in means.collect()}} \
            if means is not None else {"kind": "mean", "mean": fitted.mean_}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")
        return path
    if isinstance(fitted, (TreesFitted, ForestFitted)):
        m = fitted.model
        meta = {"kind": "trees", "columns": m.columns, "edges": [e.tolist() for e in m.edges], "base": m.base, "settings": asdict(m.settings)}
        trees = m.trees if isinstance(fitted, ForestFitted) else spark.createDataFrame(
            [(0, k, m.base, *map(bytearray, batchfit.tree_row(t))) for k, t in enumerate(m.trees)], batchfit.TREES)
        trees.write.mode("overwrite").parquet(f"{path}/model")
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")
        return path
    if not isinstance(fitted, LinearFitted):
        raise TypeError(f"no form to save {type(fitted).__name__} in")
    meta = {"kind": "linear", "intercept": fitted.intercept, "weights": fitted.weights,
            "levels": {c: list(v.items()) for c, v in fitted.levels.items()}}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")
    return path


def load_fitted(spark: SparkSession, path: str):
    import numpy as np

    from cadence.operators import batchfit
    from cadence.operators.learners import ForestFitted, LinearFitted, TreesFitted
    from cadence.operators.trees import Settings
    if not path_exists(spark, f"{path}/meta"):
        raise FileNotFoundError(f"no saved model at {path}; train one and save it with save_fitted")
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    if meta["kind"] == "mean":
        from cadence.operators.baselines import _MeanFitted
        return _MeanFitted(meta["mean"])
    if meta["kind"] == "hourly_mean":
        from cadence.operators.baselines import _HourlyFitted
        rows = [(None if h == "null" else int(h), m) for h, m in meta["hours"].items()]
        return _HourlyFitted(spark.createDataFrame(rows, "hour int, _hour_mean double"), meta["mean"])
    if meta["kind"] == "trees":
        trees, edges, settings = spark.read.schema(batchfit.TREES).parquet(f"{path}/model"), [np.array(e, np.float64) for e in meta["edges"]], Settings(**meta["settings"])
        if settings.bootstrap:
            return ForestFitted(batchfit.Forest(meta["columns"], edges, settings, trees))
        rows = sorted(trees.collect(), key=lambda r: r["tree"])
        return TreesFitted(batchfit.Ensemble(meta["columns"], edges, settings, meta["base"], [batchfit.tree_of(r) for r in rows]))
    return LinearFitted(meta["intercept"], meta["weights"], {c: {float(v): w for v, w in pairs} for c, pairs in meta["levels"].items()})


# --- A8-A10 nested metrics documents ----------------------------------------------------------------
METRIC_STRUCT = "struct<rmsle:double,rmse:double,mae:double,r2:double>"

_M = ("rmsle", "rmse", "mae", "r2")


def metrics_document(model: str, per_fold: DataFrame, holdout: DataFrame) -> DataFrame:
    """R5 document for one model as one nested row: folds array, mean, std, holdout."""
    ms = lambda pre: F.struct(*[F.col(f"{pre}{m}").alias(m) for m in _M])
    cv = per_fold.agg(
        F.count(F.lit(1)).alias("n_splits"),
        F.sort_array(F.collect_list(F.struct("fold", *_M))).alias("_folds"),  # one row per fold: bounded by k
        *[F.avg(m).alias(f"mean_{m}") for m in _M], *[F.stddev_pop(m).alias(f"std_{m}") for m in _M])
    cv = cv.select(F.struct("n_splits", F.transform("_folds", lambda s: F.struct(*[s[m].alias(m) for m in _M]))
                            .alias("folds"), ms("mean_").alias("mean"), ms("std_").alias("std")).alias("cv"))
    ho = holdout.select(F.struct(ms("").alias("metrics"), "n_train", "n_holdout").alias("holdout"))
    return cv.unionByName(ho, allowMissingColumns=True).agg(
        F.first("cv", ignorenulls=True).alias("cv"), F.first("holdout", ignorenulls=True).alias("holdout")) \
        .select(F.lit(model).alias("model"), "cv", "holdout")


REPORT_DOC_SCHEMA = (f"map<string, struct<cv:struct<folds:array<{METRIC_STRUCT}>, mean:{METRIC_STRUCT}, "
                     f"n_splits:bigint, std:{METRIC_STRUCT}>, day_of_month_holdout:struct<metrics:{METRIC_STRUCT}, "
                     f"n_holdout:bigint, n_train:bigint>>>")


def write_metrics_report(docs: DataFrame, path: str) -> str:
    """The metrics file as one JSON document keyed by model name
    (model -> {cv: {folds, mean, n_splits, std}, day_of_month_holdout: {...}}).
    One row per model goes into the map (a handful of rows), written as text."""
    entry = F.struct(F.col("model").alias("key"), F.struct(
        F.struct("cv.folds", "cv.mean", "cv.n_splits", "cv.std").alias("cv"),
        F.struct("holdout.metrics", "holdout.n_holdout", "holdout.n_train").alias("day_of_month_holdout")
    ).alias("value"))
    doc = docs.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value"))
    doc.write.mode("overwrite").text(path)
    return path


def read_metrics_report(spark: SparkSession, path: str) -> DataFrame:
    """Read the keyed document back into one nested row per model."""
    raw = spark.read.option("wholetext", True).text(path)
    m = raw.select(F.explode(F.from_json("value", REPORT_DOC_SCHEMA)).alias("model", "d"))
    return m.select("model", F.col("d.cv").alias("cv"),
                    F.struct("d.day_of_month_holdout.metrics", "d.day_of_month_holdout.n_train",
                             "d.day_of_month_holdout.n_holdout").alias("holdout"))


def flatten_metrics(doc: DataFrame) -> DataFrame:
    """(model, view, stat, metric, value) from the nested document."""
    def long(view, stat, col):
        return doc.select("model", F.lit(view).alias("view"), F.lit(stat).alias("stat"),
                          F.explode(F.map_from_arrays(F.array(*[F.lit(m) for m in _M]),
                                                      F.array(*[F.col(f"{col}.{m}") for m in _M]))))
    out = long("cv", "mean", "cv.mean").unionByName(long("cv", "std", "cv.std")).unionByName(
        long("holdout", "value", "holdout.metrics"))
    return out.select("model", "view", "stat", F.col("key").alias("metric"), "value")


def fold_records(doc: DataFrame) -> DataFrame:
    """(model, fold number, metric, value) via ``posexplode`` of the folds."""
    f = doc.select("model", F.posexplode("cv.folds").alias("pos", "m"))
    return f.select("model", (F.col("pos") + 1).alias("fold"),
                    F.explode(F.map_from_arrays(F.array(*[F.lit(m) for m in _M]),
                                                F.array(*[F.col(f"m.{m}") for m in _M])))) \
        .select("model", "fold", F.col("key").alias("metric"), "value")


def write_gap_report(per_gap: DataFrame, path: str) -> str:
    """The gap-diagnostic record as one JSON document:
    ``{gaps: [...], models: {model: {by_gap: {"<gap>": {rmsle, rmse, mae, r2}},
    cv_rmsle_delta_gap<g>_minus_gap0: x}}}`` from rows (model, gap, rmsle, rmse, mae, r2)
    - one row per model and gap, a handful of rows."""
    gaps = sorted(r[0] for r in per_gap.select("gap").distinct().collect())
    last = gaps[-1]
    by_model = per_gap.groupBy("model").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(
            F.col("gap").cast("string").alias("key"),
            F.struct(*[F.col(m) for m in _M]).alias("value"))))).alias("by_gap"),
        (F.max(F.when(F.col("gap") == last, F.col("rmsle"))) - F.max(F.when(F.col("gap") == 0, F.col("rmsle"))))
        .alias(f"cv_rmsle_delta_gap{last}_minus_gap0"))
    doc = by_model.agg(F.to_json(F.struct(
        F.array(*[F.lit(g) for g in gaps]).alias("gaps"),
        F.map_from_entries(F.collect_list(F.struct(
            F.col("model").alias("key"), F.struct("by_gap", f"cv_rmsle_delta_gap{last}_minus_gap0").alias("value"))))
        .alias("models"))).alias("value"))
    doc.write.mode("overwrite").text(path)
    return path


def read_gap_report(spark: SparkSession, path: str) -> DataFrame:
    """A10: the record back as long rows (model, gap, metric, value)."""
    schema = f"struct<gaps:array<int>, models:map<string, struct<by_gap:map<string, {METRIC_STRUCT}>>>>"
    raw = spark.read.option("wholetext", True).text(path).select(F.from_json("value", schema).alias("d"))
    models = raw.select(F.explode("d.models").alias("model", "m"))
    gaps = models.select("model", F.explode("m.by_gap").alias("gap", "g"))
    return gaps.select("model", F.col("gap").cast("int").alias("gap"), F.explode(F.map_from_arrays(
        F.array(*[F.lit(m) for m in _M]), F.array(*[F.col(f"g.{m}") for m in _M]))).alias("metric", "value"))


def sweep_long(long: DataFrame, metric: str = "rmsle") -> DataFrame:
    """A10: (model, gap, cv_<metric>, delta against gap 0) by conditional aggregation."""
    one = long.filter(F.col("metric") == metric).select("model", "gap", F.col("value").alias(f"cv_{metric}"))
    base = one.groupBy("model").agg(F.max(F.when(F.col("gap") == 0, F.col(f"cv_{metric}"))).alias("_b"))
    return one.join(base, "model").withColumn("delta", F.col(f"cv_{metric}") - F.col("_b")).drop("_b")

"""Validation harnesses: day-of-month holdout (M13) and expanding-fold CV.

``cv_report`` fits a fresh model per fold on a filtered frame of the ranked,
checkpointed rows. For the two baselines ``cv_baseline_one_pass`` does all folds in
one scan: sums and counts per (training segment, hour) are small, their running
totals give every fold's fitted means, and each validation row is scored once.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.config import Config
from cadence.functions.metrics import fold_summary, report
from cadence.operators.baselines import Estimator
from cadence.operators.order import join_small
from cadence.operators.splits import ranked_with_folds, refold, split_holdout

Predictor = Callable[[DataFrame, DataFrame, str], DataFrame]
FOLD_THREADS = 4


def fit_predict(est: Estimator) -> Predictor:
    def run(train: DataFrame, evaluate: DataFrame, label: str) -> DataFrame:
        return est.fit(train, label).predict(evaluate)
    return run


def holdout_predictions(predictor: Predictor, df: DataFrame, cfg: Config = Config()) -> DataFrame:
    train, hold = split_holdout(df, cfg)
    return predictor(train, hold, cfg.target)


def evaluate_holdout(predictor: Predictor, df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Fit on days 1-15, score days 16+; four metrics plus both row counts."""
    train, hold = split_holdout(df, cfg)
    pred = predictor(train, hold, cfg.target)
    n_train = train.count()
    return report(pred, cfg.target, "pred", with_n=True).select(
        "rmsle", "rmse", "mae", "r2", F.lit(n_train).cast("long").alias("n_train"),
        F.col("n").alias("n_holdout"))


def cv_report(predictor: Predictor, df: DataFrame, cfg: Config = Config(), gap: int | None = None,
              folds=None) -> DataFrame:
    """A fresh fit per fold; one metrics row per fold (fold, rmsle, rmse, mae, r2, n).

    ``folds`` = a ``(tagged, plan)`` pair from ``ranked_with_folds`` to reuse one
    ranking across many models and arms."""
    tagged, plan = folds if folds is not None else ranked_with_folds(df, cfg, gap)

    def one(f):
        train = tagged.filter(F.col("rank") < f.train_end)
        val = tagged.filter(F.col("val_fold") == f.fold)
        pred = predictor(train, val, cfg.target)
        return report(pred, cfg.target, "pred").withColumn("fold", F.lit(f.fold))

    # Fits are eager Spark jobs; a few driver threads keep the cluster busy while
    # a small fold's job would leave executors idle. Each fit is still distributed.
    with ThreadPoolExecutor(max_workers=min(FOLD_THREADS, len(plan))) as pool:
        parts = list(pool.map(one, plan))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("fold", "rmsle", "rmse", "mae", "r2", "n")


def baseline_folds(df: DataFrame, cfg: Config = Config(), labels=None):
    """The ``(tagged, plan)`` pair of both baselines: only what their one-pass CV reads
    is shuffled and written for the ranks."""
    read = dict.fromkeys([*cfg.order_cols, cfg.target, *(labels or ()), *(c for c in ("hour",) if c in df.columns)])
    return ranked_with_folds(df.select(*read), cfg)


def cv_baseline_one_pass(df: DataFrame | None, by_hour: bool, cfg: Config = Config(),
                         gap: int | None = None, labels=None, folds=None) -> DataFrame:
    """M12 for M1 (``by_hour=False``) and M2 (``by_hour=True``) in one scan.

    Small tables only: (segment, hour) sums -> (fold, hour) means, <= k * 24 rows.
    ``labels`` (e.g. the two sub-targets, M19) fits one mean model per label and
    sums their predictions; the score is always against ``cfg.target``. ``folds`` = a
    pair from ``baseline_folds``: one ranking serves both models and every gap, and
    ``df`` is then not read.
    """
    labels = list(labels or [cfg.target])
    tagged, plan = refold(*(folds or baseline_folds(df, cfg, labels)), cfg, gap)
    k = len(plan)
    hour_col = [F.col("hour").cast("int").alias("hour")] if by_hour else []
    sums = [F.sum(F.col(lb).cast("double")).alias(f"s{j}") for j, lb in enumerate(labels)]
    seg = (tagged.filter(F.col("train_seg") <= k)
           .groupBy(F.col("train_seg"), *hour_col).agg(*sums, F.count(F.lit(1)).alias("c")))
    # at most (k + 1) x 24 rows, read by both the hourly and the global table
    seg = seg.sparkSession.createDataFrame(seg.collect(), seg.schema)
    # A segment's rows train every fold from the segment on: explode to those folds.
    per_fold = seg.withColumn("fold", F.explode(F.sequence(F.col("train_seg"), F.lit(k))))
    means = lambda pre: [(F.sum(f"s{j}") / F.sum("c")).alias(f"{pre}{j}") for j in range(len(labels))]
    glob = per_fold.groupBy("fold").agg(*means("_g"))
    val = tagged.filter(F.col("val_fold").isNotNull()).withColumnRenamed("val_fold", "fold")
    if by_hour:
        hourly = per_fold.groupBy("fold", "hour").agg(*means("_h"))
        val = join_small(val.withColumn("hour", F.col("hour").cast("int")), hourly, ["fold", "hour"], "left", rows_bound=24 * k)
    scored = join_small(val, glob, "fold", "left", rows_bound=k)
    parts = [F.coalesce(F.col(f"_h{j}"), F.col(f"_g{j}")) if by_hour else F.col(f"_g{j}") for j in range(len(labels))]
    pred = parts[0]
    for p in parts[1:]:
        pred = pred + p
    scored = scored.withColumn("pred", pred)
    return report(scored, cfg.target, "pred", by=["fold"]).select("fold", "rmsle", "rmse", "mae", "r2", "n")


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """E32 applied to a CV result."""
    return fold_summary(per_fold)

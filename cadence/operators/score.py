"""Scoring unlabeled rows (M15) and the prediction artifact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.config import Config
from cadence.functions.features import clip0
from cadence.operators.baselines import Fitted

SUBMISSION_COLUMNS = ("datetime", "count")


def make_prediction_frame(model: Fitted, test: DataFrame, cfg: Config = Config(),
                          keep_key: bool = False) -> DataFrame:
    """``datetime, count`` for the unlabeled rows, never negative.

    Spark rows have no position, so the row key travels with the prediction
    (``keep_key=True``) and the writer orders by (datetime, key).
    """
    pred = model.predict(test, out="_pred")
    keys = [c for c in cfg.order_cols if c != cfg.datetime_col]
    cols = [F.col(cfg.datetime_col)] + ([F.col(k) for k in keys] if keep_key else [])
    return pred.select(*cols, clip0(F.col("_pred")).alias(cfg.target))


def check_submission_columns(df: DataFrame, cfg: Config = Config()) -> None:
    expected = [cfg.datetime_col, cfg.target]
    if df.columns != expected:
        raise ValueError(f"prediction frame must have columns {expected}, got {df.columns}.")

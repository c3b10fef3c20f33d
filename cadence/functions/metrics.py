"""Scoring metrics as aggregate expressions (E26-E32): one pass, partial aggregation.

All four are computed on the original count scale; the prediction is clipped at
zero before ``log1p`` for RMSLE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.features import clip0

METRICS = ("rmsle", "rmse", "mae", "r2")
# np.allclose defaults: |a - b| <= atol + rtol * |b|
ATOL, RTOL = 1e-8, 1e-5


def mae(y: Column, p: Column) -> Column:
    """E26."""
    return F.avg(F.abs(p - y))


def rmse(y: Column, p: Column) -> Column:
    """E27."""
    return F.sqrt(F.avg((p - y) * (p - y)))


def r2(y: Column, p: Column) -> Column:
    """1 - SS_res / SS_tot; a constant target scores 1 when every prediction is
    close to it, else 0."""
    ss_res = F.sum((p - y) * (p - y))
    ss_tot = F.var_pop(y) * F.count(y)
    all_close = F.count_if(F.abs(y - p) > F.lit(ATOL) + F.lit(RTOL) * F.abs(p)) == 0
    return F.when(ss_tot == 0, F.when(all_close, F.lit(1.0)).otherwise(F.lit(0.0))) \
        .otherwise(1 - ss_res / ss_tot)


def rmsle(y: Column, p: Column) -> Column:
    """E29."""
    d = F.log1p(clip0(p)) - F.log1p(y)
    return F.sqrt(F.avg(d * d))


def report_columns(y: Column, p: Column, with_n: bool = True) -> list[Column]:
    cols = [rmsle(y, p).alias("rmsle"), rmse(y, p).alias("rmse"), mae(y, p).alias("mae"),
            r2(y, p).alias("r2")]
    if with_n:
        cols.append(F.count(F.lit(1)).alias("n"))
    return cols


def report(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = (),
           with_n: bool = True) -> DataFrame:
    """The four metrics together, optionally per key (model, fold, arm...)."""
    cols = report_columns(F.col(y), F.col(pred), with_n)
    return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)


def search_score(y: Column, p: Column) -> Column:
    """Negated RMSLE (greater is better)."""
    return -rmsle(y, p)


def fold_summary(per_fold: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population std over folds of each metric."""
    aggs = []
    for m in METRICS:
        aggs += [F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}")]
    aggs.append(F.count(F.lit(1)).alias("n_splits"))
    return per_fold.groupBy(*by).agg(*aggs) if by else per_fold.agg(*aggs)

"""Validation splits: day-of-month holdout, chronological rank and expanding folds.

Fold rule (expanding window, ``k`` splits, gap ``g`` over ``n`` time-ordered rows):
``size = n // (k + 1)``; fold ``i`` (0-based) validates ranks
``[n - (k - i) * size, n - (k - i - 1) * size)`` and trains on ``[0, start - g)``.
Only the scalar ``n`` reaches the driver; fold membership is arithmetic on the rank.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.config import HOLDOUT_DAY_THRESHOLD, UNLABELED_DAY_THRESHOLD, Config
from cadence.operators.order import ordered_positions


def holdout_flag(dt: Column) -> Column:
    """Day of month >= 16 is holdout."""
    return F.dayofmonth(dt) >= HOLDOUT_DAY_THRESHOLD


def split_holdout(df: DataFrame, cfg: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """(train days 1-15, holdout days 16+). A stored ``day`` key column (processed
    tables) is used directly so the predicate reaches the Parquet scan."""
    if "day" in df.columns:
        flag = F.col("day") >= HOLDOUT_DAY_THRESHOLD
    else:
        flag = holdout_flag(F.col(cfg.datetime_col))
    return df.filter(~flag), df.filter(flag)


def three_way_label(dt: Column) -> Column:
    """Train 1-15, holdout 16-19, unlabeled 20+."""
    d = F.dayofmonth(dt)
    return (F.when(d < HOLDOUT_DAY_THRESHOLD, F.lit("train"))
            .when(d < UNLABELED_DAY_THRESHOLD, F.lit("holdout")).otherwise(F.lit("unlabeled")))


def chronological_rank(df: DataFrame, cfg: Config = Config(), rank_col: str = "rank") -> DataFrame:
    """Exact 0-based position in (datetime, row key) order, distributed."""
    return ordered_positions(df, list(cfg.order_cols), rank_col=rank_col)


@dataclass(frozen=True)
class Fold:
    fold: int          # 1-based, chronological
    train_end: int     # train ranks [0, train_end)
    val_start: int     # validation ranks [val_start, val_end)
    val_end: int


def fold_plan(n: int, n_splits: int, gap: int = 0) -> list[Fold]:
    """The expanding-window folds for ``n`` rows."""
    if n_splits < 2:
        raise ValueError(f"{n_splits} folds are too few; two are the least")
    if n_splits + 1 > n:
        raise ValueError(f"{n} rows can't be cut into {n_splits + 1} parts")
    size = n // (n_splits + 1)
    if n - gap - n_splits * size <= 0:
        raise ValueError(f"a gap of {gap} leaves the first of {n_splits} folds of {size} rows no training rows")
    folds = []
    for i in range(n_splits):
        start = n - (n_splits - i) * size
        folds.append(Fold(i + 1, start - gap, start, start + size))
    return folds


def fold_columns(rank: Column, plan: list[Fold]) -> dict[str, Column]:
    """``val_fold``: the fold a row validates (NULL if none);
    ``train_seg``: first fold whose training part contains the row (k + 1 if none).
    A row trains every fold from ``train_seg`` on."""
    val = None
    for f in plan:
        cond = (rank >= f.val_start) & (rank < f.val_end)
        val = F.when(cond, F.lit(f.fold)) if val is None else val.when(cond, F.lit(f.fold))
    seg = None
    for f in plan:
        cond = rank < f.train_end
        seg = F.when(cond, F.lit(f.fold)) if seg is None else seg.when(cond, F.lit(f.fold))
    seg = seg.otherwise(F.lit(len(plan) + 1))
    return {"val_fold": val.cast("int"), "train_seg": seg.cast("int")}


def ranked_with_folds(df: DataFrame, cfg: Config = Config(), gap: int | None = None):
    """Rank rows chronologically and tag fold membership. Returns (frame, plan)."""
    ranked = chronological_rank(df, cfg)
    n = ranked.count()
    plan = fold_plan(n, cfg.n_splits, cfg.gap if gap is None else gap)
    return ranked.withColumns(fold_columns(F.col("rank"), plan)), plan


def refold(tagged: DataFrame, plan: list[Fold], cfg: Config = Config(), gap: int | None = None):
    """Tag the same ranks for another gap (neither they nor the row count depend on it)."""
    plan = fold_plan(plan[-1].val_end, cfg.n_splits, cfg.gap if gap is None else gap)
    return tagged.withColumns(fold_columns(F.col("rank"), plan)), plan


def fold_membership(tagged: DataFrame, plan: list[Fold]) -> DataFrame:
    """Long form (row x fold x part) of the range condition ``rank < train_end``
    / ``rank in [val_start, val_end)``. A row appears at most k + 1 times; only
    used where a per-fold frame is really needed."""
    k = len(plan)
    train_parts = F.when(F.col("train_seg") <= k,
                         F.transform(F.sequence(F.col("train_seg"), F.lit(k)),
                                     lambda f: F.struct(f.alias("fold"), F.lit("train").alias("part"))))
    val_part = F.when(F.col("val_fold").isNotNull(),
                      F.array(F.struct(F.col("val_fold").alias("fold"), F.lit("validation").alias("part"))))
    parts = F.concat(F.coalesce(train_parts, F.array().cast("array<struct<fold:int,part:string>>")),
                     F.coalesce(val_part, F.array().cast("array<struct<fold:int,part:string>>")))
    return tagged.withColumn("_m", F.explode(parts)).withColumn("fold", F.col("_m.fold")) \
        .withColumn("part", F.col("_m.part")).drop("_m")


def fold_boundaries(tagged: DataFrame, plan: list[Fold], cfg: Config = Config()) -> DataFrame:
    """Per fold and part, row count and first/last datetime. Only the 4k
    boundary rows are read after the rank; counts come from the plan."""
    spark = tagged.sparkSession
    spec = []
    for f in plan:
        if f.train_end > 0:
            spec.append((f.fold, "train", 0, f.train_end - 1, f.train_end))
        spec.append((f.fold, "validation", f.val_start, f.val_end - 1, f.val_end - f.val_start))
    positions = sorted({p for s in spec for p in (s[2], s[3])})
    edges = tagged.filter(F.col("rank").isin(positions)).select(
        F.col("rank"), F.col(cfg.datetime_col).alias("dt"))
    plan_df = spark.createDataFrame(spec, "fold int, part string, first_rank long, last_rank long, n_rows long")
    first = edges.withColumnRenamed("rank", "first_rank").withColumnRenamed("dt", "first_datetime")
    last = edges.withColumnRenamed("rank", "last_rank").withColumnRenamed("dt", "last_datetime")
    return (plan_df.join(F.broadcast(first), "first_rank").join(F.broadcast(last), "last_rank")
            .select("fold", "part", "n_rows", "first_datetime", "last_datetime"))


def search_subset(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Days 1-15 only (the search never sees the holdout); fold it afterwards."""
    train, _ = split_holdout(df, cfg)
    return train

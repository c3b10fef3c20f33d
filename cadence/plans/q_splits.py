"""Registered queries for section C (splits), W1 (chronological position) and D6."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import Config
from cadence.functions import features as fx
from cadence.operators import splits as sp
from cadence.plans.common import finish, i, ts
from cadence.plans.fixtures_sql import F2, F4, feature_select, with_
from cadence.plans.q_features import CFG4, F2_COLS, FEATS, sel
from cadence.plans.registry import query
from cadence.plans.sqlparts import fold_cte
from cadence.sources.fixtures import demand_rows, labeled, lineitem_rows

CFG = Config()
LAB = "lab AS (SELECT * FROM f2x WHERE day(datetime) < 20)"


def lab2(spark, sf):
    """Labeled F2 rows (days 1-19) with features."""
    return fx.build_features(labeled(demand_rows(spark, sf)), CFG)


def _lab_sql(*more):
    return with_(F2, feature_select("f2"), LAB, *more)


@query("c01_holdout_split", _lab_sql() + f"SELECT {i('row_id')} AS row_id, "
       f"{i('CASE WHEN day(datetime) >= 16 THEN 1 ELSE 0 END')} AS is_holdout FROM lab")
def c01(spark, sf):
    return finish(lab2(spark, sf).select("row_id", sp.holdout_flag(F.col("datetime")).alias("is_holdout")))


@query("c02_three_way_label", with_(F2) + f"SELECT {i('row_id')} AS row_id, CASE WHEN day(datetime) < 16 THEN "
       "'train' WHEN day(datetime) < 20 THEN 'holdout' ELSE 'unlabeled' END AS part FROM f2")
def c02(spark, sf):
    return finish(demand_rows(spark, sf).select("row_id", sp.three_way_label(F.col("datetime")).alias("part")))


@query("c03_chronological_order", _lab_sql() + f"SELECT {i('row_id')} AS row_id, "
       f"{i('row_number() OVER (ORDER BY datetime, row_id) - 1')} AS rank FROM lab")
def c03(spark, sf):
    # project before ranking: the position table written to shared storage holds
    # only the columns read afterwards
    return finish(sp.chronological_rank(lab2(spark, sf).select("datetime", "row_id"), CFG).select("row_id", "rank"))


_F4K = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice"


@query("w01_chronological_position", with_(F4) + f"SELECT {sel(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_extendedprice'])}, "
       f"{i(f'row_number() OVER (ORDER BY datetime, {_F4K}) - 1')} AS rank FROM f4")
def w01(spark, sf):
    ranked = sp.chronological_rank(lineitem_rows(spark, sf).select(*CFG4.order_cols), CFG4)
    return finish(ranked.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "rank"))


def _folds_sql(gap, src="lab"):
    return fold_cte(src, "datetime, row_id", 5, gap)


def _fold_q(spark, sf, gap, frame=None):
    df = (frame if frame is not None else lab2(spark, sf)).select("datetime", "row_id")
    tagged, _ = sp.ranked_with_folds(df, CFG, gap)
    # 0 = the row validates no fold (keeps the column non-null)
    return finish(tagged.select("row_id", "rank", F.coalesce("val_fold", F.lit(0)).alias("val_fold"), "train_seg"))


_FOLD_COLS = (f"{i('row_id')} AS row_id, {i('rank')} AS rank, {i('coalesce(val_fold, 0)')} AS val_fold, "
              f"{i('train_seg')} AS train_seg FROM fz")


@query("c04_expanding_folds", _lab_sql(_folds_sql(0)) + "SELECT " + _FOLD_COLS)
def c04(spark, sf):
    return _fold_q(spark, sf, 0)


@query("c06_fold_gap", _lab_sql(_folds_sql(48)) + "SELECT " + _FOLD_COLS)
def c06(spark, sf):
    return _fold_q(spark, sf, 48)


@query("c07_search_subset_folds", _lab_sql("s15 AS (SELECT * FROM lab WHERE day(datetime) < 16)",
                                           _folds_sql(0, "s15")) + "SELECT " + _FOLD_COLS)
def c07(spark, sf):
    return _fold_q(spark, sf, 0, sp.search_subset(lab2(spark, sf), CFG))


_C05 = """bounds AS (
  SELECT fold, part, CAST(n_rows AS BIGINT) AS n_rows, first_rank, last_rank FROM (
    SELECT f AS fold, 'train' AS part, 0 AS first_rank, te - 1 AS last_rank, te AS n_rows
    FROM (SELECT f, n - (5 - f + 1) * (n // 6) AS te FROM range(1, 6) t(f), (SELECT count(*) AS n FROM lab))
    UNION ALL
    SELECT f, 'validation', vs, vs + (n // 6) - 1, n // 6
    FROM (SELECT f, n, n - (5 - f + 1) * (n // 6) AS vs FROM range(1, 6) t(f), (SELECT count(*) AS n FROM lab))
  )
),
rk AS (SELECT datetime, row_number() OVER (ORDER BY datetime, row_id) - 1 AS rank FROM lab)"""


@query("c05_fold_boundaries", _lab_sql(_C05) + f"""SELECT {i('b.fold')} AS fold, b.part, {i('b.n_rows')} AS n_rows,
  {ts('a.datetime')} AS first_datetime, {ts('z.datetime')} AS last_datetime
FROM bounds b JOIN rk a ON a.rank = b.first_rank JOIN rk z ON z.rank = b.last_rank""")
def c05(spark, sf):
    tagged, plan = sp.ranked_with_folds(lab2(spark, sf).select("datetime", "row_id"), CFG, 0)
    return finish(sp.fold_boundaries(tagged, plan, CFG))


@query("c09_distinct_hours", with_(F2, feature_select("f2")) +
       f"SELECT DISTINCT {sel(['hour', 'hour_sin', 'hour_cos'])} FROM f2x")
def c09(spark, sf):
    df = fx.build_features(demand_rows(spark, sf), CFG)
    return finish(df.select("hour", "hour_sin", "hour_cos").distinct().orderBy("hour"))


@query("c10_head", with_(F2, feature_select("f2")) +
       f"SELECT {sel(F2_COLS + FEATS)} FROM f2x ORDER BY datetime, row_id LIMIT 5")
def c10(spark, sf):
    df = fx.build_features(demand_rows(spark, sf), CFG)
    return finish(df.orderBy("datetime", "row_id").limit(5))


@query("d06_fold_membership", _lab_sql(_folds_sql(0)) + f"""
SELECT {i('row_id')} AS row_id, {i('t.fold')} AS fold, 'train' AS part FROM fz, range(1, 6) t(fold)
WHERE t.fold >= fz.train_seg
UNION ALL
SELECT {i('row_id')}, {i('val_fold')}, 'validation' FROM fz WHERE val_fold IS NOT NULL""")
def d06(spark, sf):
    tagged, plan = sp.ranked_with_folds(lab2(spark, sf).select("datetime", "row_id"), CFG, 0)
    return finish(sp.fold_membership(tagged, plan).select("row_id", "fold", "part"))


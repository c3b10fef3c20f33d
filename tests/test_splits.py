"""Expanding folds and the day-of-month holdout."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadence.config import Config
from cadence.operators import splits as sp


def reference_folds(n, k, gap):
    size = n // (k + 1)
    out = []
    for start in range(n - k * size, n, size):
        out.append((list(range(0, start - gap)), list(range(start, start + size))))
    return out


@pytest.mark.parametrize("n,k,gap", [(10886, 5, 0), (10886, 5, 48), (100, 5, 3), (37, 4, 0)])
def test_fold_plan_matches_rule(n, k, gap):
    plan = sp.fold_plan(n, k, gap)
    ref = reference_folds(n, k, gap)
    for f, (tr, va) in zip(plan, ref):
        assert f.train_end == len(tr) and f.val_start == va[0] and f.val_end == va[-1] + 1


def test_first_fold_with_gap_48():
    assert sp.fold_plan(10886, 5, 48)[0].train_end == 1768


def test_too_many_splits():
    with pytest.raises(ValueError):
        sp.fold_plan(5, 5, 0)


def test_folds_disjoint_and_ordered(spark):
    rows = [(dt.datetime(2011, 1, 1) + dt.timedelta(hours=h), h) for h in range(120)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, row_id long").repartition(3)
    tagged, plan = sp.ranked_with_folds(df, Config())
    for f in plan:
        tr = tagged.filter(F.col("rank") < f.train_end).agg(F.max("datetime")).first()[0]
        va = tagged.filter(F.col("val_fold") == f.fold).agg(F.min("datetime"), F.count("*")).first()
        assert tr < va[0] and va[1] == 120 // 6


def test_holdout_split_complete_and_disjoint(spark):
    rows = [(dt.datetime(2011, 1, d, 0), d) for d in range(1, 20)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, row_id long")
    tr, ho = sp.split_holdout(df)
    days_tr = {r[0] for r in tr.select(F.dayofmonth("datetime")).collect()}
    days_ho = {r[0] for r in ho.select(F.dayofmonth("datetime")).collect()}
    assert days_tr == set(range(1, 16)) and days_ho == set(range(16, 20))


def test_gap_reaches_the_splitter(spark):
    rows = [(dt.datetime(2011, 1, 1) + dt.timedelta(hours=h), h) for h in range(120)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, row_id long")
    _, p0 = sp.ranked_with_folds(df, Config(), gap=0)
    _, p5 = sp.ranked_with_folds(df, Config(), gap=5)
    assert [a.train_end - b.train_end for a, b in zip(p0, p5)] == [5] * 5


def test_one_ranking_serves_every_gap(spark):
    from cadence.operators import validate as va
    rows = [(dt.datetime(2011, 1, 1) + dt.timedelta(hours=i), i, i % 24, float(i % 24 + i % 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, row_id long, hour int, count double")
    folds = va.baseline_folds(df, Config())
    for gap in (0, 12):
        for by_hour in (False, True):
            once = va.cv_baseline_one_pass(None, by_hour, Config(), gap=gap, folds=folds).orderBy("fold").collect()
            assert once == va.cv_baseline_one_pass(df, by_hour, Config(), gap=gap).orderBy("fold").collect()

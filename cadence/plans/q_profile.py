"""Registered queries for the profile reports (E1-E3, E6-E22), D2, D3, W5, W6."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import Config
from cadence.functions import features as fx
from cadence.operators import baselines as bl
from cadence.operators import profile as pr
from cadence.operators import validate as va
from cadence.operators.order import quantile_cut
from cadence.plans.common import finish, i, r
from cadence.plans.fixtures_sql import F1, F2, F3, F4, feature_select, with_
from cadence.plans.q_features import CFG4, FEATS
from cadence.plans.q_models import HM, _base
from cadence.plans.q_splits import LAB, lab2
from cadence.plans.registry import query
from cadence.sources.fixtures import demand_hourly, demand_rows, lineitem_rows, orders_rows, unlabeled

CFG = Config()
RAW = ["datetime", "row_id", "season", "holiday", "workingday", "weather", "temp", "atemp", "humidity",
       "windspeed", "casual", "registered", "count"]
RAW_TYPES = {"datetime": "timestamp_ntz", "row_id": "bigint", "season": "int", "holiday": "int",
             "workingday": "int", "weather": "int", "temp": "double", "atemp": "double", "humidity": "double",
             "windspeed": "double", "casual": "double", "registered": "double", "count": "double"}
FEAT_TYPES = {"hour": "smallint", "dayofweek": "smallint", "month": "smallint", "year": "smallint",
              "is_weekend": "tinyint", **{c: "float" for c in FEATS[5:]}}
FLOATS = {"temp", "atemp", "humidity", "windspeed", "casual", "registered", "count"}
TEST = "tst AS (SELECT * FROM f2x WHERE day(datetime) >= 20)"


def test2(spark, sf):
    return fx.build_features(unlabeled(demand_rows(spark, sf), drop=()), CFG)


# --- E1-E3 ------------------------------------------------------------------------------
def _e01_sql():
    parts = []
    for c in RAW:
        miss = f"count(*) FILTER (WHERE {c} IS NULL" + (f" OR isnan({c}))" if c in FLOATS else ")")
        parts.append(f"SELECT '{c}' AS column, '{RAW_TYPES[c]}' AS dtype, {i(miss)} AS n_missing, "
                     f"{i('count(*)')} AS n_rows FROM f2")
    return with_(F2) + "\nUNION ALL\n".join(parts)


@query("e01_table_profile", _e01_sql())
def e01(spark, sf):
    return finish(pr.table_profile(demand_rows(spark, sf)))


@query("e02_leakage_identity", with_(F2) +
       f"SELECT {i('count(*)')} AS n_rows, {i('count(*) FILTER (WHERE casual + registered IS DISTINCT FROM count)')} "
       "AS n_mismatch FROM f2")
def e02(spark, sf):
    return finish(pr.leakage_identity(demand_rows(spark, sf)))


@query("e02_leakage_identity_hourly", with_(F1) +
       f"SELECT {i('count(*)')} AS n_rows, {i('count(*) FILTER (WHERE casual + registered IS DISTINCT FROM count)')} "
       "AS n_mismatch FROM f1")
def e02h(spark, sf):
    return finish(pr.leakage_identity(demand_hourly(spark, sf)))


def _e03_sql():
    parts = [f"SELECT '{c}' AS column, '{FEAT_TYPES[c]}' AS dtype, {r(f'min({c})')} AS min, {r(f'max({c})')} AS max "
             "FROM f2x" for c in FEATS]
    return with_(F2, feature_select("f2")) + "\nUNION ALL\n".join(parts)


@query("e03_feature_profile", _e03_sql())
def e03(spark, sf):
    return finish(pr.feature_profile(fx.build_features(demand_rows(spark, sf), CFG), FEATS))


# --- E6-E8 ------------------------------------------------------------------------------
@query("e06_mean_hour_workingday", with_(F2, feature_select("f2"), LAB) +
       f"SELECT {i('hour')} AS hour, {i('workingday')} AS workingday, {r('avg(count)')} AS mean, {i('count(*)')} AS n "
       "FROM lab GROUP BY hour, workingday")
def e06(spark, sf):
    return finish(pr.group_mean(lab2(spark, sf), ["hour", "workingday"], "count"))


@query("e07_mean_by_month", with_(F3, feature_select("f3")) +
       f"SELECT {i('month')} AS month, {r('avg(count)', 4)} AS mean, {i('count(*)')} AS n FROM f3x GROUP BY month")
def e07(spark, sf):
    return finish(pr.group_mean(fx.build_features(orders_rows(spark, sf), CFG), ["month"], "count"), digits=4)


@query("e08_level_counts", with_(F2, feature_select("f2"), LAB) +
       f"SELECT {i('weather')} AS weather, {i('count(*)')} AS n FROM lab GROUP BY weather")
def e08(spark, sf):
    return finish(pr.level_counts(lab2(spark, sf), "weather"))


# --- E9/D2, E10/D3 ---------------------------------------------------------------------------
SHARE_COLS = ["season", "weather", "holiday", "workingday", "hour", "month"]


def _share_sql(src, name):
    parts = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS level FROM {src}" for c in SHARE_COLS)
    return (f'{name} AS (SELECT "column", level, count(*) / sum(count(*)) OVER (PARTITION BY "column") AS share '
            f'FROM ({parts}) GROUP BY "column", level)')


@query("e09_level_shares", with_(F2, feature_select("f2"), LAB, TEST, _share_sql("lab", "sa"), _share_sql("tst", "sb")) +
       f"SELECT \"column\", level, {r('coalesce(sa.share, 0)')} AS train_share, {r('coalesce(sb.share, 0)')} AS test_share "
       "FROM sa FULL OUTER JOIN sb USING (\"column\", level)")
def e09(spark, sf):
    return finish(pr.level_shares(lab2(spark, sf), test2(spark, sf), SHARE_COLS))


_D02 = ["hour", "month"]


@query("d02_align_levels", with_(F2, feature_select("f2"), LAB, TEST, _share_sql("lab", "sa"), _share_sql("tst", "sb")) +
       f"SELECT \"column\", level, {r('coalesce(sb.share, 0) - coalesce(sa.share, 0)')} AS shift "
       "FROM sa FULL OUTER JOIN sb USING (\"column\", level) WHERE \"column\" IN ('hour', 'month')")
def d02(spark, sf):
    """Levels of both sides side by side, absent ones as 0: the shift of each share."""
    both = pr.level_shares(lab2(spark, sf), test2(spark, sf), _D02)
    return finish(both.select("column", "level", (F.col("test_share") - F.col("train_share")).alias("shift")))


NUM4 = ["temp", "atemp", "humidity", "windspeed"]


def _mom_sql(src, side):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", avg({c}) AS {side}_mean, stddev_samp({c}) AS {side}_std "
                              f"FROM {src}" for c in NUM4)


@query("e10_moments_compare", with_(F2, feature_select("f2"), LAB, TEST) +
       f"SELECT \"column\", {r('a.train_mean')} AS train_mean, {r('a.train_std')} AS train_std, "
       f"{r('b.test_mean')} AS test_mean, {r('b.test_std')} AS test_std FROM ({_mom_sql('lab', 'train')}) a "
       f"FULL OUTER JOIN ({_mom_sql('tst', 'test')}) b USING (\"column\")")
def e10(spark, sf):
    return finish(pr.moments_compare(lab2(spark, sf), test2(spark, sf), NUM4))


@query("d03_align_moments", with_(F2, feature_select("f2"), LAB, TEST) +
       f"SELECT \"column\", {r('b.test_mean - a.train_mean')} AS mean_shift, {r('b.test_std / a.train_std')} AS std_ratio "
       f"FROM ({_mom_sql('lab', 'train')}) a FULL OUTER JOIN ({_mom_sql('tst', 'test')}) b USING (\"column\")")
def d03(spark, sf):
    both = pr.moments_compare(lab2(spark, sf), test2(spark, sf), NUM4)
    return finish(both.select("column", (F.col("test_mean") - F.col("train_mean")).alias("mean_shift"),
                              (F.col("test_std") / F.col("train_std")).alias("std_ratio")))


# --- E11, E12 ---------------------------------------------------------------------------------
CORR9 = ["season", "holiday", "workingday", "weather", "temp", "atemp", "humidity", "windspeed", "count"]


def _corr_sql(a, b):
    return (f"covar_pop({a}, {b}) / (CASE WHEN stddev_pop({a}) * stddev_pop({b}) <> 0 "
            f"THEN stddev_pop({a}) * stddev_pop({b}) END)")


@query("e11_pearson_matrix", with_(F2, feature_select("f2"), LAB) + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(_corr_sql(a, b))} AS r FROM lab" for a in CORR9 for b in CORR9))
def e11(spark, sf):
    return finish(pr.pearson_matrix(lab2(spark, sf), CORR9))


CORR_F4 = ["season", "holiday", "workingday", "weather", "temp", "atemp", "humidity", "windspeed"] + FEATS


@query("e12_pearson_with_target", with_(F4, feature_select("f4")) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(_corr_sql(f'CAST({c} AS DOUBLE)', 'count'))} AS r FROM f4x" for c in CORR_F4))
def e12(spark, sf):
    return finish(pr.pearson_with_target(fx.build_features(lineitem_rows(spark, sf), CFG4), CORR_F4, "count"))


# --- E13, E15, W6 ------------------------------------------------------------------------------
@query("e13_pivot_weather_season", with_(F2, feature_select("f2"), LAB) +
       f"SELECT {i('weather')} AS weather, " + ", ".join(
           f"{r(f'avg(count) FILTER (WHERE season = {s})')} AS season_{s}" for s in range(1, 5)) +
       " FROM lab GROUP BY weather")
def e13a(spark, sf):
    p = pr.pivot_mean(lab2(spark, sf), "weather", "season", [1, 2, 3, 4], "count")
    return finish(p.select("weather", *[F.col(str(s)).alias(f"season_{s}") for s in range(1, 5)]))


@query("e13_pivot_weather_hour", with_(F2, feature_select("f2"), LAB) +
       f"SELECT {i('weather')} AS weather, " + ", ".join(
           f"{r(f'avg(count) FILTER (WHERE hour = {h})')} AS h{h}" for h in range(24)) +
       " FROM lab GROUP BY weather")
def e13b(spark, sf):
    p = pr.pivot_mean(lab2(spark, sf), "weather", "hour", list(range(24)), "count")
    return finish(p.select("weather", *[F.col(str(h)).alias(f"h{h}") for h in range(24)]))


# Edges table rows: idx = position of the upper edge (2..len); bin number = idx - 1.
def _edges_sql2(src, col, name, q=5):
    probs = ", ".join(str(k / q) for k in range(q + 1))
    return (f"{name} AS (SELECT CAST(j - 1 AS BIGINT) AS bin, e[j - 1] AS lo, e[j] AS hi "
            f"FROM (SELECT list_sort(list_distinct(quantile_cont({col}, [{probs}]))) AS e FROM {src}), "
            f"range(2, {q + 2}) t(j) WHERE j <= len(e))")


def _in_bin(col, b):
    return f"({col} <= {b}.hi AND ({col} > {b}.lo OR ({b}.bin = 1 AND {col} >= {b}.lo)))"


@query("e14_quantile_cut", with_(F2, feature_select("f2"), LAB, _edges_sql2("lab", "temp", "te")) +
       f"SELECT {i('row_id')} AS row_id, {i('te.bin')} AS bin, {r('te.lo')} AS lo, {r('te.hi')} AS hi "
       f"FROM lab JOIN te ON {_in_bin('lab.temp', 'te')}")
def e14(spark, sf):
    cut = quantile_cut(lab2(spark, sf), "temp", 5, "b")
    return finish(cut.select("row_id", F.col("b.idx").alias("bin"), F.col("b.lo").alias("lo"), F.col("b.hi").alias("hi")))


@query("e15_quantile_pivot", with_(F2, feature_select("f2"), LAB, _edges_sql2("lab", "humidity", "he"),
                                   _edges_sql2("lab", "temp", "te")) +
       f"SELECT {i('he.bin')} AS row_bin, {i('te.bin')} AS col_bin, {r('min(he.lo)')} AS row_lo, "
       f"{r('min(he.hi)')} AS row_hi, {r('min(te.lo)')} AS col_lo, {r('min(te.hi)')} AS col_hi, "
       f"{r('avg(count)')} AS mean, {i('count(*)')} AS n FROM lab JOIN he ON {_in_bin('lab.humidity', 'he')} "
       f"JOIN te ON {_in_bin('lab.temp', 'te')} GROUP BY he.bin, te.bin")
def e15(spark, sf):
    return finish(pr.quantile_bin_pivot(lab2(spark, sf), "humidity", "temp", "count", 5))


# --- E16-E19 on the hourly-mean holdout predictions ---------------------------------------------
def _pred(spark, sf):
    return va.holdout_predictions(va.fit_predict(bl.HourlyMeanBaseline()), lab2(spark, sf), CFG)


_PQ = [*_base(), *HM]


@query("e15_quantile_grid", with_(F2, feature_select("f2"), LAB, _edges_sql2("lab", "humidity", "he"),
                                  _edges_sql2("lab", "temp", "te")) +
       f"SELECT {i('he.bin')} AS row_bin, " + ", ".join(f"{r(f'avg(count) FILTER (WHERE te.bin = {k})')} AS mean_{k}" for k in range(1, 6)) +
       f" FROM lab JOIN he ON {_in_bin('lab.humidity', 'he')} JOIN te ON {_in_bin('lab.temp', 'te')} GROUP BY he.bin")
def e15g(spark, sf):
    return finish(pr.quantile_bin_grid(lab2(spark, sf), "humidity", "temp", "count"))


@query("e16_error_by_demand_fifth", with_(*_PQ, _edges_sql2("p", "y", "ye")) +
       f"SELECT {i('ye.bin')} AS bin, {r('min(ye.lo)')} AS lo, {r('min(ye.hi)')} AS hi, {i('count(*)')} AS n, "
       f"{r('sqrt(avg((pred - y) * (pred - y)))')} AS rmse, {r('avg(abs(pred - y))')} AS mae, "
       f"{r('avg(pred - y)')} AS mean_bias FROM p JOIN ye ON {_in_bin('p.y', 'ye')} GROUP BY ye.bin")
def e16(spark, sf):
    return finish(pr.error_by_bin(_pred(spark, sf), "count", "pred", 5))


@query("e17_mae_by_weather", with_(*_PQ) +
       f"SELECT {i('weather')} AS weather, {r('avg(abs(pred - y))')} AS mae, {i('count(*)')} AS n FROM p GROUP BY weather")
def e17a(spark, sf):
    return finish(pr.error_by_group(_pred(spark, sf), ["weather"], "count", "pred"))


@query("e17_mae_by_season", with_(*_PQ) +
       f"SELECT {i('season')} AS season, {r('avg(abs(pred - y))')} AS mae, {i('count(*)')} AS n FROM p GROUP BY season")
def e17b(spark, sf):
    return finish(pr.error_by_group(_pred(spark, sf), ["season"], "count", "pred"))


@query("e18_mae_pivot_workingday_hour", with_(*_PQ) +
       f"SELECT {i('workingday')} AS workingday, " + ", ".join(
           f"{r(f'avg(abs(pred - y)) FILTER (WHERE hour = {h})')} AS h{h}" for h in range(24)) +
       " FROM p GROUP BY workingday")
def e18(spark, sf):
    p = _pred(spark, sf).withColumn("abs_err", F.abs(F.col("pred") - F.col("count")))
    wide = pr.pivot_mean(p, "workingday", "hour", list(range(24)), "abs_err")
    return finish(wide.select("workingday", *[F.col(str(h)).alias(f"h{h}") for h in range(24)]))


def _box_sql(src, group, value):
    q = (f"qs AS (SELECT {group} AS g, quantile_cont({value}, 0.0) AS mn, quantile_cont({value}, 0.25) AS q1, "
         f"quantile_cont({value}, 0.5) AS med, quantile_cont({value}, 0.75) AS q3, quantile_cont({value}, 1.0) AS mx "
         f"FROM {src} WHERE {value} IS NOT NULL GROUP BY {group})")
    f = ("fe AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo_f, q3 + 1.5::DOUBLE * (q3 - q1) AS hi_f FROM qs)")
    body = (f"SELECT {i('fe.g')} AS {group}, {r('min(fe.mn)')} AS min, {r('min(fe.q1)')} AS q1, "
            f"{r('min(fe.med)')} AS median, {r('min(fe.q3)')} AS q3, {r('min(fe.mx)')} AS max, "
            f"{r('min(fe.lo_f)')} AS lo_fence, {r('min(fe.hi_f)')} AS hi_fence, {i('count(*)')} AS n, "
            f"{i(f'count(*) FILTER (WHERE NOT (s.{value} >= fe.lo_f AND s.{value} <= fe.hi_f))')} AS n_outliers, "
            f"{r(f'min(s.{value}) FILTER (WHERE s.{value} >= fe.lo_f AND s.{value} <= fe.hi_f)')} AS whisker_lo, "
            f"{r(f'max(s.{value}) FILTER (WHERE s.{value} >= fe.lo_f AND s.{value} <= fe.hi_f)')} AS whisker_hi "
            f"FROM {src} s JOIN fe ON s.{group} = fe.g WHERE s.{value} IS NOT NULL GROUP BY fe.g")
    return q, f, body


def _box_q(sql_parts, ctes):
    q, f, body = sql_parts
    return with_(*ctes, q, f) + body


@query("e19_box_count_by_weather", _box_q(_box_sql("lab", "weather", "count"), [F2, feature_select("f2"), LAB]))
def e19a(spark, sf):
    return finish(pr.five_number_summary(lab2(spark, sf), "weather", "count"))


@query("e19_box_residual_by_hour", _box_q(_box_sql("pr", "hour", "res"), [*_PQ, "pr AS (SELECT hour, pred - y AS res FROM p)"]))
def e19b(spark, sf):
    p = _pred(spark, sf).select("hour", (F.col("pred") - F.col("count")).alias("res"))
    return finish(pr.five_number_summary(p, "hour", "res"))


# --- E20-E22 ------------------------------------------------------------------------------------
def _hist_sql(src, expr, bins=60):
    """NumPy's binning: index, then correction against lo + k * step (last edge = hi)."""
    def edge(k):
        return f"(CASE WHEN {k} = {bins} THEN mm.hi ELSE CAST({k} AS DOUBLE) * mm.step + mm.lo END)"
    i0 = f"least(CAST(floor(({expr} - mm.lo) / (mm.hi - mm.lo) * {bins}) AS BIGINT), {bins - 1})"
    return (f"mm0 AS (SELECT min({expr}) AS lo0, max({expr}) AS hi0 FROM {src}),\n"
            f"mm AS (SELECT CASE WHEN hi0 = lo0 THEN lo0 - 0.5 ELSE lo0 END AS lo, "
            f"CASE WHEN hi0 = lo0 THEN hi0 + 0.5 ELSE hi0 END AS hi, "
            f"((CASE WHEN hi0 = lo0 THEN hi0 + 0.5 ELSE hi0 END) - (CASE WHEN hi0 = lo0 THEN lo0 - 0.5 ELSE lo0 END)) / {bins} AS step FROM mm0),\n"
            f"h0 AS (SELECT {expr} AS v, {i0} AS i0 FROM {src} CROSS JOIN mm WHERE {expr} IS NOT NULL),\n"
            f"h1 AS (SELECT v, CASE WHEN v < {edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM h0 CROSS JOIN mm),\n"
            f"hb AS (SELECT CASE WHEN v >= {edge('(i1 + 1)')} AND i1 <> {bins - 1} THEN i1 + 1 ELSE i1 END AS bin "
            f"FROM h1 CROSS JOIN mm)")


def _hist_q(expr):
    lo = "(CASE WHEN bin = 60 THEN mm.hi ELSE CAST(bin AS DOUBLE) * mm.step + mm.lo END)"
    hi = "(CASE WHEN bin + 1 = 60 THEN mm.hi ELSE CAST(bin + 1 AS DOUBLE) * mm.step + mm.lo END)"
    return with_(F2, feature_select("f2"), LAB, _hist_sql("lab", expr)) + (
        f"SELECT {i('bin')} AS bin, {r(f'min({lo})')} AS lo, {r(f'min({hi})')} AS hi, {i('count(hb.b)')} AS n "
        "FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(0, 60)) CROSS JOIN mm "
        "LEFT JOIN (SELECT bin AS b FROM hb) hb ON hb.b = bin GROUP BY bin")


@query("e20_histogram_count", _hist_q("count"))
def e20a(spark, sf):
    return finish(pr.histogram(lab2(spark, sf), "count", 60))


@query("e20_histogram_log_count", _hist_q("ln(1 + count)"))
def e20b(spark, sf):
    df = lab2(spark, sf).withColumn("log_count", F.log1p("count"))
    return finish(pr.histogram(df, "log_count", 60))


@query("e21_skew", with_(F2, feature_select("f2"), LAB) +
       f"SELECT {r('skewness(count)')} AS skew_count, {r('skewness(ln(1 + count))')} AS skew_log_count FROM lab")
def e21(spark, sf):
    df = lab2(spark, sf)
    return finish(df.agg(pr.adjusted_skew(F.col("count")).alias("skew_count"),
                         pr.adjusted_skew(F.log1p("count")).alias("skew_log_count")))


def _kde_sql(src, col, side, grid=200, nb=512):
    return (f"st_{side} AS (SELECT min({col}) AS lo, max({col}) AS hi, stddev_samp({col}) AS sd, count({col}) AS n, "
            f"stddev_samp({col}) * pow(count({col}), -1.0::DOUBLE / 5.0::DOUBLE) AS h FROM {src}),\n"
            f"bn_{side} AS (SELECT CAST(least(floor(({col} - st.lo) / ((st.hi - st.lo) / {nb})), {nb - 1}) AS INTEGER) AS b, "
            f"count(*) AS c FROM {src} CROSS JOIN st_{side} st WHERE {col} IS NOT NULL GROUP BY 1),\n"
            f"kd_{side} AS (SELECT '{side}' AS side, g.point, st.lo - 3.0::DOUBLE * st.h + g.point * "
            f"((st.hi + 3.0::DOUBLE * st.h - (st.lo - 3.0::DOUBLE * st.h)) / {grid - 1}) AS x, "
            f"sum(b.c * exp(-0.5::DOUBLE * pow(((st.lo - 3.0::DOUBLE * st.h + g.point * ((st.hi + 3.0::DOUBLE * st.h "
            f"- (st.lo - 3.0::DOUBLE * st.h)) / {grid - 1})) - (st.lo + (b.b + 0.5::DOUBLE) * ((st.hi - st.lo) / {nb}))) / st.h, 2)) "
            f"/ (sqrt(2 * pi()) * st.h * st.n)) AS density "
            f"FROM bn_{side} b CROSS JOIN st_{side} st CROSS JOIN range(0, {grid}) g(point) GROUP BY g.point, st.lo, st.h, st.hi)")


@query("e22_kde_temp", with_(F2, feature_select("f2"), LAB, TEST, _kde_sql("lab", "temp", "train"),
                             _kde_sql("tst", "temp", "test")) +
       f"SELECT side, {i('point')} AS point, {r('x')} AS x, {r('density', 9)} AS density FROM kd_train "
       f"UNION ALL SELECT side, {i('point')}, {r('x')}, {r('density', 9)} FROM kd_test")
def e22(spark, sf):
    a = pr.kde_binned(lab2(spark, sf), "temp").withColumn("side", F.lit("train"))
    b = pr.kde_binned(test2(spark, sf), "temp").withColumn("side", F.lit("test"))
    return finish(a.unionByName(b).select("side", "point", "x", "density"), overrides={"density": 9})


# --- W5, W6 ------------------------------------------------------------------------------------
@query("w05_unpivot_feature_profile", _e03_sql())
def w05p(spark, sf):
    """Wide (one row of lo_/hi_ aggregates) to long (one row per column)."""
    return finish(pr.feature_profile(fx.build_features(demand_rows(spark, sf), CFG), FEATS))


@query("w05_melt_pivot", with_(F2, feature_select("f2"), LAB) +
       f"SELECT {i('w.weather')} AS weather, {i('h.hour')} AS hour, {r('avg(lab.count)')} AS mean "
       "FROM (SELECT DISTINCT weather FROM lab) w CROSS JOIN (SELECT range AS hour FROM range(0, 24)) h "
       "LEFT JOIN lab ON lab.weather = w.weather AND lab.hour = h.hour GROUP BY w.weather, h.hour")
def w05(spark, sf):
    """The weather x hour grid of means back to one row per cell, empty cells too."""
    grid = pr.pivot_mean(lab2(spark, sf), "weather", "hour", list(range(24)), "count")
    return finish(pr.melt(grid, ["weather"], {str(h): h for h in range(24)}, "hour", "mean"))


@query("w06_pivot_shares", with_(F2, feature_select("f2"), LAB, _share_sql("lab", "sa")) +
       "SELECT \"column\", " + ", ".join(f"{r(f'max(share) FILTER (WHERE level = {chr(39)}{v}{chr(39)})')} AS level_{v}"
                                     for v in range(1, 5)) + " FROM sa WHERE \"column\" IN ('season', 'weather') GROUP BY \"column\"")
def w06(spark, sf):
    long = pr._shares(lab2(spark, sf), ["season", "weather"], "share")
    wide = long.groupBy("column").pivot("level", ["1", "2", "3", "4"]).agg(F.max("share"))
    return finish(wide.select("column", *[F.col(str(v)).alias(f"level_{v}") for v in range(1, 5)]))

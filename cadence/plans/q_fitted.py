"""Registered queries for fitted transforms and corrections: M3, M4, M5, M8, M17,
E23, E24, E25, B22, B23, B24, M27, M31. Every fit uses days 1-15 only; every
transform is applied to the holdout rows (days 16-19)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cadence.config import LINEAR_NUMERIC, LINEAR_ONE_HOT, LINEAR_PASSTHROUGH, Config
from cadence.functions import features as fx
from cadence.operators import correct as co
from cadence.operators import fitted as ft
from cadence.operators.learners import LinearSpec
from cadence.operators.splits import split_holdout
from cadence.plans.common import finish, i, r
from cadence.plans.fixtures_sql import with_
from cadence.plans.q_models import _base
from cadence.plans.q_splits import lab2
from cadence.plans.registry import query

CFG = Config()
B = _base()


def _split(spark, sf):
    return split_holdout(lab2(spark, sf), CFG)


# --- M3 scaling, M4 one-hot, M5 routing ----------------------------------------------------------
_ST = "st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) "
                                   f"ELSE 1.0 END AS s_{c}" for c in LINEAR_NUMERIC) + " FROM tr)"


@query("m03_standard_scaling", with_(*B, _ST) + f"SELECT {i('row_id')} AS row_id, " + ", ".join(
    f"{r(f'({c} - m_{c}) / s_{c}')} AS {c}__s" for c in LINEAR_NUMERIC) + " FROM ho CROSS JOIN st")
def m03(spark, sf):
    train, hold = _split(spark, sf)
    sc = ft.PopulationScaler(LINEAR_NUMERIC, "__s").fit(train)
    return finish(sc.transform(hold).select("row_id", *[f"{c}__s" for c in LINEAR_NUMERIC]))


_LV = "lv AS (" + " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS feature, {c} AS level FROM tr" for c in LINEAR_ONE_HOT) + ")"


@query("m04_one_hot", with_(*B, _LV) + f"SELECT {i('ho.row_id')} AS row_id, lv.feature || '_' || CAST(lv.level AS VARCHAR) "
       f"AS name, {r('CASE WHEN (lv.feature = ' + chr(39) + 'season' + chr(39) + ' AND ho.season = lv.level) OR (lv.feature = ' + chr(39) + 'weather' + chr(39) + ' AND ho.weather = lv.level) THEN 1.0 ELSE 0.0 END')} AS value "
       "FROM ho CROSS JOIN lv")
def m04(spark, sf):
    train, hold = _split(spark, sf)
    oh = ft.OneHotLevels(LINEAR_ONE_HOT).fit(train)
    names = oh.output_columns()
    wide = oh.transform(hold).select("row_id", *names)
    return finish(wide.unpivot("row_id", names, "name", "value"))


def _m05_sql():
    parts = [f"SELECT row_id, '{c}__s' AS name, ({c} - m_{c}) / s_{c} AS value FROM ho CROSS JOIN st"
             for c in LINEAR_NUMERIC]
    parts += [f"SELECT row_id, '{c}', CAST({c} AS DOUBLE) FROM ho" for c in LINEAR_PASSTHROUGH]
    parts += [f"SELECT ho.row_id, lv.feature || '_' || CAST(lv.level AS VARCHAR), CASE WHEN ho.{c} = lv.level THEN 1.0 "
              f"ELSE 0.0 END FROM ho JOIN lv ON lv.feature = '{c}'" for c in LINEAR_ONE_HOT]
    return with_(*B, _ST, _LV, "mx AS (" + " UNION ALL ".join(parts) + ")") + (
        f"SELECT {i('row_id')} AS row_id, name, {r('value')} AS value FROM mx")


@query("m05_column_routing", _m05_sql())
def m05(spark, sf):
    """The assembled linear design matrix in long form (row, column name, value)."""
    train, hold = _split(spark, sf)
    spec = LinearSpec().fit(train)
    names = spec.names()
    x = spec.transform(hold).select("row_id", F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("name"),
                                                           vector_to_array("features").alias("value")).alias("z"))
    return finish(x.select("row_id", F.explode("z").alias("e")).select("row_id", "e.name", "e.value"))


# --- M8 log target with a closed-form inner model ------------------------------------------------
_LOGM = ["lm AS (SELECT hour, avg(ln(1 + count)) AS m FROM tr GROUP BY hour)",
         "lg AS (SELECT avg(ln(1 + count)) AS g FROM tr)",
         "lp AS (SELECT ho.*, ho.count AS y, coalesce(lm.m, lg.g) AS log_pred FROM ho LEFT JOIN lm USING (hour) CROSS JOIN lg)"]
_CLIP = "CASE WHEN exp(log_pred) - 1 < 0 THEN 0.0 ELSE exp(log_pred) - 1 END"


@query("m08_log_target_wrapper", with_(*B, *_LOGM) +
       f"SELECT {i('row_id')} AS row_id, {r('log_pred')} AS log_pred, {r(_CLIP)} AS pred FROM lp")
def m08(spark, sf):
    train, hold = _split(spark, sf)
    model = co.HourlyLogMean().fit(train, "count")
    return finish(model.predict(hold).select("row_id", "log_pred", "pred"))


# --- M17 fitted weather transforms: E23/B23, E24/B24 -------------------------------------------------
_MED = "md AS (SELECT coalesce(quantile_cont(windspeed, 0.5) FILTER (WHERE windspeed > 0), 0.0) AS fill FROM tr)"


@query("c08_positive_only", with_(*B) + f"SELECT {i('row_id')} AS row_id, {r('windspeed')} AS windspeed FROM tr WHERE windspeed > 0")
def c08(spark, sf):
    train, _ = _split(spark, sf)
    return finish(ft.positive_only(train, "windspeed").select("row_id", "windspeed"))


@query("e23_positive_median", with_(*B, _MED) + f"SELECT {r('fill')} AS fill_value FROM md")
def e23(spark, sf):
    train, _ = _split(spark, sf)
    imp = ft.WindspeedZeroImputer().fit(train)
    return finish(spark.createDataFrame([(imp.fill_value_,)], "fill_value double"))


@query("b23_windspeed_fill", with_(*B, _MED) + f"SELECT {i('row_id')} AS row_id, "
       f"{r('CASE WHEN windspeed = 0 THEN fill ELSE windspeed END')} AS windspeed FROM ho CROSS JOIN md")
def b23(spark, sf):
    train, hold = _split(spark, sf)
    return finish(ft.WindspeedZeroImputer().fit(train).transform(hold).select("row_id", "windspeed"))


_LS = ("ls AS (SELECT avg(temp) AS m1, avg(humidity) AS m2, avg(atemp) AS my, var_pop(temp) AS v11, "
       "var_pop(humidity) AS v22, covar_pop(temp, humidity) AS v12, covar_pop(temp, atemp) AS v1y, "
       "covar_pop(humidity, atemp) AS v2y FROM tr)")
_CF = ("cf AS (SELECT (v22 * v1y - v12 * v2y) / (v11 * v22 - v12 * v12) AS b1, "
       "(v11 * v2y - v12 * v1y) / (v11 * v22 - v12 * v12) AS b2, m1, m2, my FROM ls)")


@query("e24_least_squares_2", with_(*B, _LS, _CF) + f"SELECT {r('my - b1 * m1 - b2 * m2')} AS intercept, "
       f"{r('b1')} AS coef_temp, {r('b2')} AS coef_humidity FROM cf")
def e24(spark, sf):
    train, _ = _split(spark, sf)
    a, b, c = ft.least_squares_2(train, "atemp", "temp", "humidity")
    return finish(spark.createDataFrame([(a, b, c)], "intercept double, coef_temp double, coef_humidity double"))


@query("b24_atemp_rebuild", with_(*B, _LS, _CF) + f"SELECT {i('row_id')} AS row_id, "
       f"{r('(my - b1 * m1 - b2 * m2) + b1 * temp + b2 * humidity')} AS atemp FROM ho CROSS JOIN cf")
def b24(spark, sf):
    train, hold = _split(spark, sf)
    return finish(ft.AtempRecalibrator().fit(train).transform(hold).select("row_id", "atemp"))


@query("m17_fitted_transforms", with_(*B, _MED, _LS, _CF) + f"SELECT {i('row_id')} AS row_id, "
       f"{r('CASE WHEN windspeed = 0 THEN fill ELSE windspeed END')} AS windspeed, "
       f"{r('(my - b1 * m1 - b2 * m2) + b1 * temp + b2 * humidity')} AS atemp, {r('temp')} AS temp "
       "FROM ho CROSS JOIN md CROSS JOIN cf")
def m17(spark, sf):
    """Both transforms fitted on days 1-15 and chained on the holdout rows."""
    train, hold = _split(spark, sf)
    w = ft.WindspeedZeroImputer().fit(train)
    a = ft.AtempRecalibrator().fit(w.transform(train))
    return finish(a.transform(w.transform(hold)).select("row_id", "windspeed", "atemp", "temp"))


# --- E25, B22, M27, M31 smearing ------------------------------------------------------------------------
_THETA = ["ltr AS (SELECT tr.count AS y, coalesce(lm.m, lg.g) AS log_pred FROM tr LEFT JOIN lm USING (hour) CROSS JOIN lg)",
          "th AS (SELECT avg(exp(ln(1 + y) - log_pred)) AS theta FROM ltr)"]
_SMEAR = "CASE WHEN theta * exp(log_pred) - 1 < 0 THEN 0.0 ELSE theta * exp(log_pred) - 1 END"
_ARMS = ["arms AS (SELECT 'uncorrected' AS arm, y, " + _CLIP + " AS pred FROM lp UNION ALL "
         "SELECT 'smeared', y, " + _SMEAR + " FROM lp CROSS JOIN th)"]


@query("e25_smearing_factor", with_(*B, *_LOGM, *_THETA) + f"SELECT {r('theta')} AS theta FROM th")
def e25(spark, sf):
    train, _ = _split(spark, sf)
    model = co.HourlyLogMean().fit(train, "count")
    return finish(co.smearing_factor(model.predict_log(train), "count"))


@query("b22_apply_smearing", with_(*B, *_LOGM, *_THETA) +
       f"SELECT {i('row_id')} AS row_id, {r('log_pred')} AS log_pred, {r(_SMEAR)} AS smeared FROM lp CROSS JOIN th")
def b22(spark, sf):
    train, hold = _split(spark, sf)
    model = co.HourlyLogMean().fit(train, "count")
    theta = co.smearing_factor(model.predict_log(train), "count").first()["theta"]
    lp = model.predict_log(hold)
    return finish(lp.select("row_id", "log_pred", fx.apply_smearing(F.col("log_pred"), theta).alias("smeared")))


def _peak_edges():
    return ("ye AS (SELECT CAST(j - 1 AS BIGINT) AS bin, e[j - 1] AS lo, e[j] AS hi FROM (SELECT list_sort(list_distinct("
            "quantile_cont(y, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM lp), range(2, 7) t(j) WHERE j <= len(e))")


_INB = "(a.y <= ye.hi AND (a.y > ye.lo OR (ye.bin = 1 AND a.y >= ye.lo)))"


def _report(y="y", p="pred"):
    from cadence.plans.sqlparts import report_sql
    return report_sql(y, p)


@query("m27_peak_overall", with_(*B, *_LOGM, *_THETA, *_ARMS) +
       f"SELECT arm, {_report()}, {r('(SELECT theta FROM th)')} AS theta FROM arms GROUP BY arm")
def m27a(spark, sf):
    theta, overall, _ = co.peak_experiment(co.HourlyLogMean(), lab2(spark, sf), CFG)
    return finish(overall.withColumn("theta", F.lit(theta)))


@query("m27_peak_by_fifth", with_(*B, *_LOGM, *_THETA, *_ARMS, _peak_edges()) +
       f"SELECT arm, {i('ye.bin')} AS bin, {r('min(ye.lo)')} AS lo, {r('min(ye.hi)')} AS hi, {i('count(*)')} AS n, "
       f"{r('sqrt(avg((pred - y) * (pred - y)))')} AS rmse, {r('avg(pred - y)')} AS mean_bias "
       f"FROM arms a JOIN ye ON {_INB} GROUP BY arm, ye.bin")
def m27b(spark, sf):
    _, _, by_bin = co.peak_experiment(co.HourlyLogMean(), lab2(spark, sf), CFG)
    return finish(by_bin)


def smearing_gate(overall, by_bin):
    """Smeared passes when RMSE and MAE improve, the top fifth's |bias|
    shrinks and RMSLE does not get worse. One aggregation over a long frame of the
    few metric values - no join."""
    long = overall.select("arm", "rmse", "mae", "rmsle").unpivot("arm", ["rmse", "mae", "rmsle"], "metric", "value")
    top_bin = by_bin.agg(F.max("bin")).first()[0]
    top = by_bin.filter(F.col("bin") == top_bin).select("arm", F.lit("bias").alias("metric"),
                                                          F.col("mean_bias").alias("value"))
    keys = [f"{a}_{m}" for a in ("uncorrected", "smeared") for m in ("rmse", "mae", "rmsle", "bias")]
    w = long.unionByName(top).withColumn("k", F.concat_ws("_", "arm", "metric")).groupBy().pivot("k", keys) \
        .agg(F.first("value"))
    c = F.col
    ok = ((c("smeared_rmse") < c("uncorrected_rmse")) & (c("smeared_mae") < c("uncorrected_mae"))
          & (F.abs(c("smeared_bias")) < F.abs(c("uncorrected_bias"))) & (c("smeared_rmsle") <= c("uncorrected_rmsle")))
    return w.select(ok.cast("int").alias("passes"), c("uncorrected_bias").alias("top_bias_uncorrected"),
                    c("smeared_bias").alias("top_bias_smeared"))


@query("m31_smearing_gate", with_(*B, *_LOGM, *_THETA, *_ARMS, _peak_edges(),
                                  f"ov AS (SELECT arm, {_report()} FROM arms GROUP BY arm)",
                                  "tb AS (SELECT arm, avg(pred - y) AS bias FROM arms a JOIN ye ON " + _INB +
                                  " WHERE ye.bin = (SELECT max(bin) FROM ye) GROUP BY arm)") +
       "SELECT CAST((s.rmse < u.rmse AND s.mae < u.mae AND abs(bs.bias) < abs(bu.bias) AND s.rmsle <= u.rmsle) AS BIGINT) "
       f"AS passes, {r('bu.bias')} AS top_bias_uncorrected, {r('bs.bias')} AS top_bias_smeared "
       "FROM ov u, ov s, tb bu, tb bs WHERE u.arm = 'uncorrected' AND s.arm = 'smeared' AND bu.arm = 'uncorrected' "
       "AND bs.arm = 'smeared'")
def m31(spark, sf):
    _, overall, by_bin = co.peak_experiment(co.HourlyLogMean(), lab2(spark, sf), CFG)
    return finish(smearing_gate(overall, by_bin))

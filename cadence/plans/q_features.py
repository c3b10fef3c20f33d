"""Registered queries for section B (projections and scalar functions) and the
source-side fixture checks. All run over every row of F2 (events), F3 (orders) or
F4 (lineitem)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import Config
from cadence.functions import features as fx
from cadence.plans.common import finish, i, r, ts
from cadence.plans.fixtures_sql import F2, F3, F4, feature_select, with_
from cadence.plans.registry import query
from cadence.sources.fixtures import demand_rows, lineitem_rows, orders_rows

CFG = Config()
CFG4 = Config(order_cols=("datetime", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"))

F2_COLS = ["datetime", "row_id", "season", "holiday", "workingday", "weather", "temp", "atemp",
           "humidity", "windspeed", "casual", "registered", "count"]
FEATS = ["hour", "dayofweek", "month", "year", "is_weekend", "hour_sin", "hour_cos", "month_sin",
         "month_cos", "hour_sin2", "hour_cos2", "hour_sin_workday", "hour_cos_workday"]
INT_COLS = {"row_id", "season", "holiday", "workingday", "weather", "hour", "dayofweek", "month", "year",
            "is_weekend", "is_morning_peak", "is_evening_peak", "is_rush_hour", "is_trend_year", "bad_weather",
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"}


def sel(cols, digits=6) -> str:
    """DuckDB select list with the same hygiene as ``finish``."""
    out = []
    for c in cols:
        if c == "datetime":
            out.append(f"{ts('datetime')} AS datetime")
        elif c in INT_COLS:
            out.append(f"{i(c)} AS {c}")
        else:
            out.append(f"{r(c, digits)} AS {c}")
    return ", ".join(out)


def f2x(spark, sf):
    return fx.build_features(demand_rows(spark, sf), CFG)


# --- fixtures (inputs of everything else) --------------------------------------------
@query("f2_demand_rows", with_(F2) + f"SELECT {sel(F2_COLS)} FROM f2")
def q_f2(spark, sf):
    return finish(demand_rows(spark, sf))


F4_COLS = ["datetime", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "season",
           "holiday", "workingday", "weather", "temp", "atemp", "humidity", "windspeed", "casual", "registered",
           "count"]


@query("f4_lineitem_rows", with_(F4) + f"SELECT {sel(F4_COLS)} FROM f4")
def q_f4(spark, sf):
    return finish(lineitem_rows(spark, sf))


# --- B1-B8 ---------------------------------------------------------------------------
_B1 = [c for c in F2_COLS if c not in ("casual", "registered")]


@query("b01_drop_leakage", with_(F2) + f"SELECT {sel(_B1)} FROM f2")
def b01(spark, sf):
    return finish(fx.drop_leakage_columns(demand_rows(spark, sf), CFG))


def _fsql(cols, src="f2", fixture=F2):
    return with_(fixture, feature_select(src)) + f"SELECT {sel(cols)} FROM {src}x"


@query("b02_calendar_parts", _fsql(["row_id", "hour", "dayofweek", "month", "year"]))
def b02(spark, sf):
    return finish(f2x(spark, sf).select("row_id", "hour", "dayofweek", "month", "year"))


@query("b03_is_weekend", _fsql(["row_id", "dayofweek", "is_weekend"]))
def b03(spark, sf):
    return finish(f2x(spark, sf).select("row_id", "dayofweek", "is_weekend"))


@query("b04_hour_cycle", _fsql(["row_id", "hour", "hour_sin", "hour_cos"]))
def b04(spark, sf):
    return finish(f2x(spark, sf).select("row_id", "hour", "hour_sin", "hour_cos"))


@query("b05_month_cycle", _fsql(["row_id", "month", "month_sin", "month_cos"], "f3", F3))
def b05(spark, sf):
    return finish(fx.build_features(orders_rows(spark, sf), CFG).select("row_id", "month", "month_sin", "month_cos"))


@query("b06_hour_harmonic", _fsql(["row_id", "hour", "hour_sin2", "hour_cos2"]))
def b06(spark, sf):
    return finish(f2x(spark, sf).select("row_id", "hour", "hour_sin2", "hour_cos2"))


@query("b07_workday_gate", _fsql(["row_id", "workingday", "hour_sin_workday", "hour_cos_workday"]))
def b07(spark, sf):
    return finish(f2x(spark, sf).select("row_id", "workingday", "hour_sin_workday", "hour_cos_workday"))


@query("b08_build_features", _fsql(F2_COLS + FEATS))
def b08(spark, sf):
    return finish(f2x(spark, sf))


@query("b08_build_features_lineitem", _fsql(F4_COLS + FEATS, "f4", F4))
def b08_f4(spark, sf):
    return finish(fx.build_features(lineitem_rows(spark, sf), CFG4))


_FAULTS = [("without_datetime", "ValueError"), ("without_workingday", "ValueError"), ("datetime_as_text", "TypeError"), ("whole", "")]


@query("b09_input_contract", " UNION ALL ".join(
    f"SELECT '{c}' AS input, '{e}' AS error, (SELECT count(*) FROM events) AS n_rows" for c, e in _FAULTS))
def b09(spark, sf):
    """The demand table with a column missing or unparsed is refused before any work; the
    whole table passes."""
    df = demand_rows(spark, sf)
    inputs = {"without_datetime": df.drop("datetime"), "without_workingday": df.drop("workingday"),
              "datetime_as_text": df.withColumn("datetime", F.col("datetime").cast("string")), "whole": df}
    rows = []
    for name, frame in inputs.items():
        try:
            fx.check_feature_input(frame, CFG)
            rows.append((name, ""))
        except (ValueError, TypeError) as e:
            rows.append((name, type(e).__name__))
    return finish(spark.createDataFrame(rows, "input string, error string").withColumn("n_rows", F.lit(df.count())))


# --- B10-B16 candidates ------------------------------------------------------------------
CANDIDATE_CTE = f"""cand AS (
  SELECT *,
    CAST(CASE WHEN hour IN (7, 8, 9) THEN 1 ELSE 0 END AS TINYINT) AS is_morning_peak,
    CAST(CASE WHEN hour IN (16, 17, 18, 19) THEN 1 ELSE 0 END AS TINYINT) AS is_evening_peak,
    CAST(CASE WHEN hour IN (7, 8, 9, 16, 17, 18, 19) THEN 1 ELSE 0 END AS TINYINT) AS is_rush_hour,
    CAST(atemp - temp AS FLOAT) AS feels_like_gap,
    CAST(temp * humidity AS FLOAT) AS temp_humidity_interaction,
    CAST(temp + (5.0::DOUBLE / 9.0::DOUBLE) * (6.11::DOUBLE * exp(17.27::DOUBLE * temp
         / (CASE WHEN 237.7::DOUBLE + temp <> 0 THEN 237.7::DOUBLE + temp END)) * humidity / 100.0::DOUBLE
         - 10.0::DOUBLE) AS FLOAT) AS comfort_index,
    CAST(CASE WHEN weather >= 3 THEN 1 ELSE 0 END AS TINYINT) AS bad_weather
  FROM f2x
)"""


def _csql(cols):
    return with_(F2, feature_select("f2"), CANDIDATE_CTE) + f"SELECT {sel(cols)} FROM cand"


def f2c(spark, sf):
    return fx.build_candidate_features(demand_rows(spark, sf), CFG)


@query("b10_peak_flags", _csql(["row_id", "hour", "is_morning_peak", "is_evening_peak", "is_rush_hour"]))
def b10(spark, sf):
    return finish(f2c(spark, sf).select("row_id", "hour", "is_morning_peak", "is_evening_peak", "is_rush_hour"))


TREND_YEAR_F3 = 1998


@query("b11_year_flag", with_(F3, feature_select("f3")) +
       f"SELECT {sel(['row_id', 'year'])}, CAST(CASE WHEN year = {TREND_YEAR_F3} THEN 1 ELSE 0 END AS BIGINT) "
       f"AS is_trend_year FROM f3x")
def b11(spark, sf):
    df = fx.build_features(orders_rows(spark, sf), CFG)
    return finish(df.select("row_id", "year", fx.year_flag(F.col("year"), TREND_YEAR_F3).alias("is_trend_year")))


@query("b12_feels_like_gap", _csql(["row_id", "feels_like_gap"]))
def b12(spark, sf):
    return finish(f2c(spark, sf).select("row_id", "feels_like_gap"))


@query("b13_temp_humidity", _csql(["row_id", "temp_humidity_interaction"]))
def b13(spark, sf):
    return finish(f2c(spark, sf).select("row_id", "temp_humidity_interaction"))


@query("b14_comfort_index", _csql(["row_id", "comfort_index"]))
def b14(spark, sf):
    return finish(f2c(spark, sf).select("row_id", "comfort_index"))


@query("b15_bad_weather", _csql(["row_id", "weather", "bad_weather"]))
def b15(spark, sf):
    return finish(f2c(spark, sf).select("row_id", "weather", "bad_weather"))


_CAND_COLS = ["is_morning_peak", "is_evening_peak", "is_rush_hour", "feels_like_gap",
              "temp_humidity_interaction", "comfort_index", "bad_weather"]


@query("b16_candidate_features", _csql(F2_COLS + FEATS + _CAND_COLS) .replace(
    "FROM cand", ", CAST(CASE WHEN year = 2012 THEN 1 ELSE 0 END AS BIGINT) AS is_2012 FROM cand"))
def b16(spark, sf):
    return finish(f2c(spark, sf).select(*F2_COLS, *FEATS, *_CAND_COLS, "is_2012"))


# --- B17-B20, B26 ---------------------------------------------------------------------
@query("b17_log1p_target", with_(F2) + f"SELECT {i('row_id')} AS row_id, {r('ln(1 + count)')} AS log_count FROM f2")
def b17(spark, sf):
    return finish(demand_rows(spark, sf).select("row_id", fx.to_log1p(F.col("count")).alias("log_count")))


_B18_Z = "(ln(1 + count) - 1.0::DOUBLE)"


@query("b18_from_log1p", with_(F2) + f"SELECT {i('row_id')} AS row_id, {r(_B18_Z)} AS z, "
       f"{r(f'CASE WHEN exp({_B18_Z}) - 1 < 0 THEN 0.0 ELSE exp({_B18_Z}) - 1 END')} AS count_back FROM f2")
def b18(spark, sf):
    z = fx.to_log1p(F.col("count")) - 1.0
    return finish(demand_rows(spark, sf).select("row_id", z.alias("z"), fx.from_log1p(z).alias("count_back")))


_X_COLS = [c for c in F2_COLS + FEATS if c not in ("datetime", "count", "casual", "registered")]


@query("b19_feature_target_split", _fsql(_X_COLS + ["count"]))
def b19(spark, sf):
    df = fx.drop_leakage_columns(f2x(spark, sf), CFG)
    x = fx.feature_columns(df, CFG)
    return finish(df.select("row_id", *x, "count"))


@query("b20_dual_target_split", _fsql([c for c in _X_COLS] + ["casual", "registered", "count"]))
def b20(spark, sf):
    df = f2x(spark, sf)
    x = fx.dual_target_columns(df, CFG)
    return finish(df.select("row_id", *x, "casual", "registered", "count"))


@query("b26_rounding", with_(F2) + f"SELECT {i('row_id')} AS row_id, "
       "round(CAST(round(temp * humidity / 7, 2) AS DOUBLE), 2) AS half_up, "
       "round(CAST(round_even(CAST(temp * humidity / 7 AS DECIMAL(18, 6)), 2) AS DOUBLE), 2) AS half_even FROM f2")
def b26(spark, sf):
    v = F.col("temp") * F.col("humidity") / 7
    return finish(demand_rows(spark, sf).select(
        "row_id", F.round(v, 2).alias("half_up"),
        F.bround(v.cast("decimal(18,6)"), 2).alias("half_even")), digits=2)

"""Demand frames derived from the driver's test tables (FIXTURES.md section 3).

These only re-shape the given tables into the schema the operators expect
(hourly demand with calendar and weather columns). They do none of the
operators' work. Each has a DuckDB twin in ``cadence.plans.fixtures_sql``.

- F1 ``demand_hourly``  one row per hour of ``events``
- F2 ``demand_rows``    one row per event (grows with the scale factor)
- F3 ``orders_rows``    one row per order, several years, no hour of day
- F4 ``lineitem_rows``  one row per line item (largest table)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.config import UNLABELED_DAY_THRESHOLD

# Row keys (with the datetime, the total order used for chronological ranks).
F4_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
ORDER_COLS = {
    "f1": ("datetime", "row_id"),
    "f2": ("datetime", "row_id"),
    "f3": ("datetime", "row_id"),
    "f4": ("datetime",) + F4_KEY,
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _calendar(dt: Column) -> list[Column]:
    return [
        F.when(F.weekday(dt) < 5, 1).otherwise(0).cast("int").alias("workingday"),
        F.when(F.dayofmonth(dt) == 1, 1).otherwise(0).cast("int").alias("holiday"),
    ]


def _k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


def hourly_aggregates() -> list[Column]:
    """The per-hour aggregates of F1 (shared by the batch and the streaming form)."""
    k = _k()
    return [
        F.count(F.lit(1)).alias("count"),
        F.count(F.when(F.col("event_type") == "purchase", 1)).alias("casual"),
        F.avg(k).alias("humidity"),
        # exact decimal sum, then one division: identical in any summation order
        (F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("avg_value"),
        F.count(F.when((F.col("event_type") == "error") & (k < 5), 1)).cast("double").alias("windspeed"),
    ]


def hourly_columns(hourly: DataFrame) -> DataFrame:
    """F1 columns from the per-hour aggregates (``datetime`` = hour start)."""
    dt = F.col("datetime")
    row_id = F.expr("unix_seconds(cast(datetime as timestamp)) div 3600")
    temp = F.col("avg_value") / 2
    return hourly.select(
        dt,
        row_id.alias("row_id"),
        (1 + F.floor((F.dayofmonth(dt) - 1) / 8)).cast("int").alias("season"),
        *_calendar(dt),
        (1 + F.floor(F.col("humidity") / 25)).cast("int").alias("weather"),
        temp.alias("temp"),
        (2 + 0.9 * temp + 0.05 * F.col("humidity") + 0.01 * (row_id % 7)).alias("atemp"),
        "humidity",
        "windspeed",
        "casual",
        (F.col("count") - F.col("casual")).alias("registered"),
        "count",
    )


def demand_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hourly demand with sub-targets that sum to the target."""
    ev = read_table(spark, sf_dir, "events").select("ts", "event_type", "value", "props")
    hourly = ev.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime")).agg(*hourly_aggregates())
    return hourly_columns(hourly)


def demand_rows_of(ev: DataFrame) -> DataFrame:
    """F2 projection of an events frame (batch or streaming)."""
    k = _k()
    dt = F.col("ts")
    temp = 5 + 30 * (F.col("event_id") % 97) / 96
    casual = F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0))
    return ev.select(
        dt.alias("datetime"),
        F.col("event_id").alias("row_id"),
        (1 + F.floor((F.dayofmonth(dt) - 1) / 8)).cast("int").alias("season"),
        *_calendar(dt),
        (1 + F.floor(k / 25)).cast("int").alias("weather"),
        temp.alias("temp"),
        (2 + 0.9 * temp + 0.05 * k + 0.01 * (F.col("event_id") % 7)).alias("atemp"),
        k.cast("double").alias("humidity"),
        F.when(k < 10, F.lit(0.0)).otherwise(k / 2.0).alias("windspeed"),
        casual.alias("casual"),
        (F.col("value") - casual).alias("registered"),
        F.col("value").alias("count"),
    )


def demand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the same columns at one row per event; ``count`` is the event value."""
    return demand_rows_of(read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value", "props"))


def orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per order; several years, no time of day, no weather numerics."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                 "o_totalprice", "o_orderdate")
    dt = F.col("o_orderdate")
    casual = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(F.lit(0.0))
    return o.select(
        dt.alias("datetime"),
        F.col("o_orderkey").alias("row_id"),
        F.quarter(dt).cast("int").alias("season"),
        *_calendar(dt),
        (1 + F.col("o_custkey") % 4).cast("int").alias("weather"),
        casual.alias("casual"),
        (F.col("o_totalprice") - casual).alias("registered"),
        F.col("o_totalprice").alias("count"),
    )


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per line item, keyed by ``F4_KEY``."""
    li = read_table(spark, sf_dir, "lineitem")
    dt = F.col("l_shipdate")
    temp = F.col("l_tax") * 400
    humidity = F.col("l_discount") * 1000
    casual = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0))
    return li.select(
        dt.alias("datetime"),
        *[F.col(c) for c in F4_KEY],
        F.quarter(dt).cast("int").alias("season"),
        *_calendar(dt),
        (1 + F.col("l_suppkey") % 4).cast("int").alias("weather"),
        temp.alias("temp"),
        (2 + 0.9 * temp + 0.05 * humidity).alias("atemp"),
        humidity.alias("humidity"),
        (F.col("l_linenumber") - 1).cast("double").alias("windspeed"),
        casual.alias("casual"),
        (F.col("l_quantity") - casual).alias("registered"),
        F.col("l_quantity").alias("count"),
    )


FIXTURES = {"f1": demand_hourly, "f2": demand_rows, "f3": orders_rows, "f4": lineitem_rows}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FIXTURES[name](spark, sf_dir)


def labeled(df: DataFrame, datetime_col: str = "datetime") -> DataFrame:
    """Days 1-19: the rows that carry a label."""
    return df.filter(F.dayofmonth(datetime_col) < UNLABELED_DAY_THRESHOLD)


def unlabeled(df: DataFrame, datetime_col: str = "datetime",
              drop=("casual", "registered", "count")) -> DataFrame:
    """Days 20+ without the target and sub-targets (the scoring frame)."""
    return df.filter(F.dayofmonth(datetime_col) >= UNLABELED_DAY_THRESHOLD).drop(*drop)

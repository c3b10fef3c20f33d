"""Registered streaming queries: the hourly table (F1) built from an event stream
with event-time windows, and the stateless features + hourly-mean scoring of the
unlabeled rows as a stream (same result as M15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import Config
from cadence.operators import baselines as bl
from cadence.plans.common import finish, i, r, ts
from cadence.plans.fixtures_sql import F1, with_
from cadence.plans.q_features import sel
from cadence.plans.q_models import _UNL, _base
from cadence.plans.q_splits import lab2
from cadence.plans.registry import query
from cadence.sources.fixtures import unlabeled
from cadence.streaming import demand as sd

CFG = Config()
F1_COLS = ["datetime", "row_id", "season", "holiday", "workingday", "weather", "temp", "atemp", "humidity",
           "windspeed", "casual", "registered", "count"]


_INTS = ["casual", "registered", "count"]


@query("s01_stream_hourly_demand", with_(F1) + f"SELECT {sel([c for c in F1_COLS if c not in _INTS])}, "
       + ", ".join(f"{i(c)} AS {c}" for c in _INTS) + " FROM f1")
def s01(spark, sf):
    out = sd.run_available(sd.hourly_demand(sd.event_stream(spark, sf)), "hourly", complete=True)
    return finish(spark.read.parquet(out))


DELIVERIES = 4
_LATE = "event_id % 97 = 0"
_ON_TIME = "(SELECT * FROM events WHERE event_id % 97 <> 0)"


@query("s03_stream_hourly_append", with_(F1.replace("FROM events", f"FROM {_ON_TIME}")) +
       f"SELECT {sel([c for c in F1_COLS if c not in _INTS])}, " + ", ".join(f"{i(c)} AS {c}" for c in _INTS) +
       f" FROM f1 WHERE CAST(f1.datetime AS TIMESTAMP) + INTERVAL 3 HOUR <= (SELECT max(ts) FROM {_ON_TIME})")
def s03(spark, sf):
    """The hourly table in append mode from four deliveries in time order. Every 97th
    event comes two deliveries late, behind the watermark, and is dropped; hours that
    the last watermark has not passed are still open."""
    events = spark.read.schema(sd.EVENTS_SCHEMA).parquet(f"{sf}/events.parquet")
    part, late = sd.delivery_of(events, DELIVERIES), F.expr(_LATE)
    dealt = events.withColumn("_d", part + F.when(late, 2).otherwise(0))
    feed = [dealt.filter(F.col("_d") == k).drop("_d") for k in range(DELIVERIES + 2)]
    out = sd.run_deliveries(spark, feed, sd.EVENTS_SCHEMA, sd.hourly_demand, "append")
    return finish(spark.read.parquet(out))


@query("s02_stream_scoring", with_(*_base(), *_UNL) +
       f"SELECT {ts('datetime')} AS datetime, {i('row_id')} AS row_id, {r('count')} AS count FROM sc")
def s02(spark, sf):
    model = bl.HourlyMeanBaseline().fit(lab2(spark, sf), "count")
    rows = unlabeled(sd.stream_rows(spark, sf))
    out = sd.run_available(sd.score_stream(rows, model.hour_means_, model.global_mean_, CFG), "scored")
    return finish(spark.read.parquet(out))


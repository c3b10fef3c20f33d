"""Structured Streaming forms of the stateless operators.

- ``hourly_demand``: the F1 hourly table from an event stream, with an event-time
  watermark and one-hour tumbling windows (state: one row per open hour).
- ``score_stream``: features (B8, stateless) and the hourly-mean model (M2) on a
  stream of demand rows; the fitted hour table (<= 24 rows) is a stream-static
  broadcast join.

``run_available`` drives a query over everything currently in the source
(``availableNow``) and leaves the result as a Parquet table in shared storage;
the checkpoint folder makes the run restartable after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.config import Config
from cadence.functions.features import build_features, clip0
from cadence.session import scratch_path
from cadence.sources.fixtures import demand_rows_of, hourly_aggregates, hourly_columns

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """The ``events`` table read as a file stream (a glob keeps other tables out)."""
    return (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(f"{sf_dir.rstrip('/')}/event[s].parquet"))


def hourly_demand(events: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Windowed hourly aggregates; watermarks need a zoned timestamp, so event time
    is cast (the session runs in UTC, so wall-clock values are unchanged)."""
    ev = events.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", watermark)
    agg = ev.groupBy(F.window("event_time", "1 hour").alias("w")).agg(*hourly_aggregates())
    return hourly_columns(agg.withColumn("datetime", F.col("w.start").cast("timestamp_ntz")).drop("w"))


def score_stream(rows: DataFrame, hour_means: DataFrame, global_mean: float, cfg: Config = Config()) -> DataFrame:
    """Stateless scoring: features, then the fitted hourly means (broadcast)."""
    feats = build_features(rows, cfg)
    j = feats.join(F.broadcast(hour_means.withColumnRenamed("hour", "_h")),
                   F.col("hour").cast("int") == F.col("_h"), "left")
    pred = clip0(F.coalesce(F.col("_hour_mean"), F.lit(global_mean)))
    return j.select(cfg.datetime_col, "row_id", pred.alias(cfg.target))


def run_available(df: DataFrame, name: str, complete: bool = False) -> str:
    """Run a streaming query over all available input and return the output path.

    ``complete=True`` (bounded replays): each batch rewrites the whole, small result
    table through ``foreachBatch``, so the last open hours are included. Otherwise
    rows append to a Parquet file sink; for the windowed aggregate that is the
    continuous mode - an hour is written once the watermark passes its end, and its
    state is dropped then, so state stays bounded by the watermark delay.
    """
    spark = df.sparkSession
    out = scratch_path(spark, f"stream-{name}")
    ck = scratch_path(spark, f"stream-{name}-ckpt")
    w = df.writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
    if complete:
        q = w.outputMode("complete").foreachBatch(
            lambda batch, _id: batch.write.mode("overwrite").parquet(out)).start()
    else:
        q = w.outputMode("append").format("parquet").start(out)
    q.awaitTermination()
    return out


def delivery_of(events: DataFrame, n: int):
    """A column 0 .. n - 1: the equal stretch of the events' time in which a row lies."""
    ends = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    lo, hi = (F.unix_timestamp(F.lit(t).cast("timestamp")) for t in ends)
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return F.floor((at - lo) * n / (hi - lo + 1)).cast("int")


def run_deliveries(spark: SparkSession, deliveries, schema: str, build, name: str) -> str:
    """Append mode over a feed that grows: each delivery (a DataFrame) is added to a
    feed folder, then the query resumes from its checkpoint and takes it as one batch.
    Rows behind the watermark are dropped, hours are written once it passes their end.
    Returns the path of the written hours."""
    feed, out, ck = (scratch_path(spark, f"stream-{name}-{part}") for part in ("feed", "out", "ckpt"))
    for rows in deliveries:
        rows.write.mode("append").parquet(feed)
        source = spark.readStream.schema(schema).parquet(feed)
        query = (build(source).writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
                 .outputMode("append").format("parquet").start(out))
        query.awaitTermination()
    return out


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 demand rows as a stream."""
    return demand_rows_of(event_stream(spark, sf_dir))

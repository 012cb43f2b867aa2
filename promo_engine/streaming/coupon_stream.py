"""Incremental cleaning and daily receipt counts over arriving coupon files.

The original job only reads bounded files; these are the same operators
(``operators.clean`` and report R1) run by Structured Streaming so new log
files are processed as they land:

* ``labelled_stream`` -- stateless: raw coupon rows -> cleaned + 15-day
  label.  Append to a parquet table; exactly-once through the checkpoint.
* ``daily_received_stream`` -- stateful: coupons received per day, with a
  watermark on the receipt date so finished days are emitted once and their
  state dropped (late rows older than the watermark are ignored).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promo_engine.operators.clean import labelled

RAW_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("coupon_id", T.LongType()),
    T.StructField("discount_rate_raw", T.StringType()),
    T.StructField("distance_raw", T.LongType()),
    T.StructField("date_received", T.DateType()),
    T.StructField("date_used", T.DateType()),
])


def raw_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source_dir)


def labelled_stream(spark: SparkSession, source_dir: str, **kw) -> DataFrame:
    return labelled(raw_stream(spark, source_dir, **kw))


def daily_received_stream(spark: SparkSession, source_dir: str, watermark: str = "30 days",
                          **kw) -> DataFrame:
    """R1 as a windowed streaming aggregate (1-day tumbling windows on the
    receipt date)."""
    s = raw_stream(spark, source_dir, **kw).where(F.col("date_received").isNotNull())
    ts = F.col("date_received").cast("timestamp")
    return (s.withColumn("ts", ts).withWatermark("ts", watermark)
            .groupBy(F.window("ts", "1 day"))
            .agg(F.count("coupon_id").alias("n_received"))
            .select(F.col("window.start").cast("date").alias("date_received"), "n_received"))


def write_stream(sdf: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 output_mode: str = "append"):
    """Start a parquet sink (``availableNow`` processes what is there and
    stops; otherwise micro-batches keep running)."""
    w = sdf.writeStream.format("parquet").option("path", path) \
        .option("checkpointLocation", checkpoint).outputMode(output_mode)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

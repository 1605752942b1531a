"""Streaming inputs: file streams of ride / fare / car lines or Parquet rows, with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabline.sources import codec

# Watermark delays of the original jobs.
RIDE_CLEANSING_DELAY = "1 second"
HOURLY_TIPS_DELAY = "60 seconds"
RIDES_AND_FARES_DELAY = "60 seconds"
ORDERED_INPUT_DELAY = "0 seconds"      # checkpointed, time-ordered sources
CAR_EVENT_DELAY = "30 seconds"


def as_event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session runs in UTC."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def with_watermark(df: DataFrame, col: str, delay: str) -> DataFrame:
    return as_event_time(df, col).withWatermark(col, delay)


def line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def parquet_stream(spark: SparkSession, path: str, schema: StructType | str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def ride_stream(spark: SparkSession, path: str, mode: str = "fail",
                max_files_per_trigger: int | None = None):
    """Ride lines (gzip is read transparently) parsed into ride rows.

    As with the batch readers, ``mode='quarantine'`` returns ``(rows, rejects)``:
    two streams over the same files, each with its own sink.
    """
    return codec.parse_rides(line_stream(spark, path, max_files_per_trigger), mode=mode)


def fare_stream(spark: SparkSession, path: str, mode: str = "fail",
                max_files_per_trigger: int | None = None):
    return codec.parse_fares(line_stream(spark, path, max_files_per_trigger), mode=mode)


def car_event_stream(spark: SparkSession, path: str, mode: str = "fail",
                     max_files_per_trigger: int | None = None):
    return codec.parse_car_events(line_stream(spark, path, max_files_per_trigger), mode=mode)

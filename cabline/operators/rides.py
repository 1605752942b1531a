"""Ride filters and ordering (cleansing, start events, event time, ride order)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.functions.geo import in_nyc
from cabline.operators.scan import AUTO, BUCKET, segmented_scan, with_buckets


def cleanse(rides: DataFrame) -> DataFrame:
    """Rides whose start and end both lie in the NYC box."""
    return rides.where(in_nyc("start_lon", "start_lat") & in_nyc("end_lon", "end_lat"))


def start_events(rides: DataFrame) -> DataFrame:
    return rides.where(F.col("is_start"))


def start_events_with_loss(rides: DataFrame, modulus: int = 1000) -> DataFrame:
    """START events, dropping ride_id % modulus == 0 (simulated data loss).

    A ride without an id is not lost: it comes out unmatched."""
    lost = F.coalesce(F.col("ride_id") % F.lit(modulus) == 0, F.lit(False))
    return rides.where(F.col("is_start") & ~lost)


def event_time(is_start="is_start", start_time="start_time", end_time="end_time"):
    """Event time of a ride record: start time for START, end time for END."""
    return F.when(F.col(is_start), F.col(start_time)).otherwise(F.col(end_time))


def with_event_time(rides: DataFrame, name: str = "event_time") -> DataFrame:
    return rides.withColumn(name, event_time())


def sort_rides(rides: DataFrame) -> DataFrame:
    """Total ride order: event time, START before END on ties (range-partitioned sort)."""
    r = rides if "event_time" in rides.columns else with_event_time(rides)
    return r.orderBy(F.col("event_time"), F.col("is_start").desc(), F.col("ride_id"))


def ride_sequence(rides: DataFrame, key: str = "driver_id", name: str = "seq",
                  bucket_seconds: float | str = AUTO) -> DataFrame:
    """Position (1-based) of each ride record in its key's ride order.

    Same numbers as ``row_number()`` over (key) ordered by event time, START
    first, ride_id -- computed with a bucketed scan so a hot key is spread
    over many tasks.
    """
    r = rides if "event_time" in rides.columns else with_event_time(rides)
    order = [F.col("event_time"), F.when(F.col("is_start"), 0).otherwise(1), F.col("ride_id")]
    return segmented_scan(with_buckets(r, [key], order, bucket_seconds), [key], order, BUCKET,
                          sums={name: F.lit(1).cast("long")}, inclusive=True)

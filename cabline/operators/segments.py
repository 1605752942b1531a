"""Driving segments of vehicle traces: gap (session) segments and stopped segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabline.functions.labels import erraticness_label
from cabline.operators.scan import (AUTO, BUCKET, epoch_micros, non_null_key, segmented_scan,
                                    with_buckets)


def segment_stats(ts: str = "ts", speed: str = "speed", throttle: str = "throttle") -> list[Column]:
    """length, start time, max speed cut to int, population std dev of throttle.

    All are algebraic aggregates, so a huge segment is pre-aggregated on the
    map side before the shuffle.
    """
    return [F.count(F.lit(1)).alias("length"),
            F.min(ts).alias("start_time"),
            F.max(speed).try_cast("int").alias("max_speed"),
            F.stddev_pop(throttle).alias("erraticness")]


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", erraticness_label("erraticness"))


def gap_segments(events: DataFrame, key: str = "car_id", ts: str = "ts",
                 gap_seconds: int = 15, speed: str = "speed", throttle: str = "throttle") -> DataFrame:
    """Segments that end where a key has no data for more than ``gap_seconds``.

    Same sessions as ``session_window(ts, gap)`` (events exactly one gap apart
    stay together).  Time is cut into buckets one gap wide: two events in one
    bucket are less than a gap apart, so a segment can only start at the
    first event of a bucket.  Hence:

    1. per (key, bucket): first and last instant -- a partial aggregate, so a
       vehicle with a third of all events contributes at most
       (time span / gap) rows, whatever its event rate;
    2. per key over those rows: a bucket starts a segment when its first
       event is more than a gap after the previous bucket's last one; every
       bucket gets the start of its segment;
    3. the buckets of a segment are combined: counts, extremes, and the throttle's
       mean and squared deviations, which move by n * (mean - segment mean)^2.
       Rows are read once and never shuffled themselves.

    An event without a time belongs to no segment, as in a session window.
    """
    events = events.where(F.col(ts).isNotNull())
    gap_us = int(gap_seconds) * 1_000_000
    b = F.floor(epoch_micros(ts) / F.lit(gap_us))
    # a null key is one vehicle, as in a session window; its non-null stand-in
    # keeps it in the equi-join below
    kv, kn = non_null_key(events, key)
    e = events.withColumns({"__kv": kv, "__kn": kn, "__b": b})
    part = ["__kv", "__kn"]
    x = F.col(throttle)
    buckets = e.groupBy(*part, "__b").agg(
        F.first(key, ignorenulls=True).alias("__key"), F.min(ts).alias("__first"),
        F.max(ts).alias("__last"), F.count(F.lit(1)).alias("__rows"),
        F.max(speed).alias("__speed"), F.count(x).alias("__n"), F.avg(x).alias("__mean"),
        (F.var_pop(x) * F.count(x)).alias("__dev"))
    w = Window.partitionBy(*part).orderBy("__b")
    prev_last = F.lag("__last").over(w)
    starts = buckets.withColumn(
        "__is_start",
        prev_last.isNull() | ((epoch_micros("__first") - epoch_micros(prev_last)) > F.lit(gap_us)))
    seg_start = F.last(F.when(F.col("__is_start"), F.col("__first")), ignorenulls=True) \
        .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    s = starts.withColumn("__seg", seg_start)
    whole = Window.partitionBy(*part, "__seg")
    n, mean = F.col("__n"), F.col("__mean")
    s = s.withColumn("__center", F.sum(n * mean).over(whole)
                     / F.nullif(F.sum(n).over(whole), F.lit(0)))
    shifted = F.sum(F.col("__dev") + n * (mean - F.col("__center")) * (mean - F.col("__center")))
    out = s.groupBy(*part, "__seg").agg(
        F.first("__key", ignorenulls=True).alias(key), F.sum("__rows").alias("length"),
        F.min("__first").alias("start_time"), F.max("__speed").try_cast("int").alias("max_speed"),
        F.when(F.sum(n) > 0, F.sqrt(shifted / F.sum(n))).alias("erraticness"),
        F.max("__last").alias("end_time"))
    return with_label(out.drop(*part, "__seg"))


def stopped_segments(events: DataFrame, key: str = "car_id", ts: str = "ts",
                     speed: str = "speed", throttle: str = "throttle",
                     bucket_seconds: float | str = AUTO) -> DataFrame:
    """Segments cut at every stop (speed == 0.0).

    A segment holds the events strictly after one stop and strictly before the
    next (events at the time of a stop belong to no segment); events after the
    last stop form the last segment.  Empty segments are not emitted.  An event
    without a time belongs to no segment and stops none.
    """
    events = events.where(F.col(ts).isNotNull())
    # an unknown (null) speed is not a stop
    stop = F.coalesce(F.col(speed) == F.lit(0.0), F.lit(False)).cast("int")
    # stops first among equal times; the hash only lets equal times be split
    order = [F.col(ts), F.lit(1) - stop, F.xxhash64(*events.columns)]
    rows = with_buckets(events.withColumn("__stop", stop), [key], order, bucket_seconds)
    scanned = segmented_scan(rows, [key], order, BUCKET,
                             sums={"__seg": F.col("__stop").cast("long")},
                             lasts={"__last_stop": F.when(F.col("__stop") == 1, F.col(ts))},
                             inclusive=True,
                             order_key=epoch_micros(ts) * F.lit(2) + (F.lit(1) - stop))
    kept = scanned.where((F.col("__stop") == 0)
                         & (F.col("__last_stop").isNull() | (F.col("__last_stop") != F.col(ts))))
    out = kept.groupBy(key, F.col("__seg").alias("segment")).agg(*segment_stats(ts, speed, throttle))
    return with_label(out)

"""Hourly tips per driver (tumbling event-time window) and the best driver per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.functions.labels import iso_instant


def hourly_tips(fares: DataFrame, ts: str = "start_time", key: str = "driver_id",
                tip: str = "tip", size: str = "1 hour") -> DataFrame:
    """Sum of tips per key and tumbling window (partial + final hash aggregate)."""
    return fares.groupBy(F.window(ts, size).alias("window"), F.col(key)) \
        .agg(F.sum(tip).alias("tips"))


def hourly_max(tips: DataFrame, key: str = "driver_id", size: str = "1 hour") -> DataFrame:
    """Per window, the key with the highest sum; ties go to the smallest key.

    Cascaded on ``window_time`` so it also works on a stream in append mode;
    grouped by window, so all hours run in parallel (no single global task).
    """
    best = F.max_by(F.struct(F.col(key).alias(key), F.col("tips").alias("tips")),
                    F.struct(F.col("tips"), -F.col(key)))
    return (tips.groupBy(F.window(F.window_time("window"), size).alias("window"))
            .agg(best.alias("best"))
            .select("window", F.col(f"best.{key}").alias(key), F.col("best.tips").alias("tips")))


def label_with_window_end(df: DataFrame, key: str = "driver_id") -> DataFrame:
    """(window end as ISO instant, key, tips as double) -- the job's output tuple."""
    return df.select(iso_instant(F.col("window.end")).alias("window_end"), F.col(key),
                     F.col("tips").cast("double").alias("tips"))


def render_tuple(df: DataFrame, key: str = "driver_id") -> DataFrame:
    """Text line ``(end,key,tips)`` for the text sink."""
    return df.select(F.format_string("(%s,%s,%s)", F.col("window_end"), F.col(key),
                                     F.col("tips")).alias("value"))

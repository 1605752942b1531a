"""Travel-time regression by direction: the fitted model and running predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.functions.geo import direction, direction_bucket, distance
from cabline.operators.scan import (AUTO, BUCKET, epoch_micros, exact, segmented_scan,
                                    with_buckets)

# Fixed value: a slope needs at least two points and sum(x*x) >= 10 * Double.MIN_VALUE.
MIN_POINTS = 2
MIN_SUM_XX = 10 * 4.9e-324


def travel_samples(pairs: DataFrame) -> DataFrame:
    """One sample per finished ride: distance and direction start->end, minutes taken."""
    p = pairs.where(F.col("end_time").isNotNull())
    minutes = (epoch_micros("end_time") - epoch_micros("start_time")) / F.lit(60_000_000.0)
    d = direction("start_lon", "start_lat", "end_lon", "end_lat")
    return p.select("ride_id", "start_time", "end_time",
                    distance("start_lon", "start_lat", "end_lon", "end_lat").alias("distance"),
                    d.alias("direction"), direction_bucket(d).alias("bucket"),
                    minutes.alias("travel_minutes"))


def _slope(n, sxy, sxx):
    """Regression through the origin; null (no prediction) below two points."""
    return F.when((n >= F.lit(MIN_POINTS)) & (sxx >= F.lit(MIN_SUM_XX)), sxy / sxx)


def fit_model(samples: DataFrame) -> DataFrame:
    """slope = sum(x*y) / sum(x*x) per direction bucket (8 rows at most)."""
    x, y = F.col("distance"), F.col("travel_minutes")
    agg = samples.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                        F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"))
    return agg.select("bucket", "n", _slope(F.col("n"), F.col("sxy"), F.col("sxx")).alias("slope"))


def predict(model: DataFrame, rides: DataFrame, bucket: str = "bucket",
            dist: str = "distance") -> DataFrame:
    """Predicted minutes, -1 when the bucket has no slope.

    Only direction buckets 0-7 exist; the model is cut to them and to one slope
    each, a proven bound, so it is broadcast.
    """
    m = F.broadcast(model.where(F.col("bucket").between(0, 7)).groupBy(F.col("bucket").alias("__b"))
                    .agg(F.max("slope").alias("slope")))
    j = rides.join(m, F.col(bucket) == F.col("__b"), "left")
    pred = F.coalesce((F.col("slope") * F.col(dist)).try_cast("int"), F.lit(-1))
    return j.withColumn("predicted", pred).drop("__b", "slope")


def running_predictions(samples: DataFrame,
                        bucket_seconds: float | str = AUTO) -> DataFrame:
    """Predict each ride from the rides of its bucket finished before it, then refine.

    Only 8 direction buckets exist, so a per-bucket window would use 8 tasks;
    the scan splits every direction into ranges of the order as well.  The sums are of
    decimals, so a truncated prediction can't depend on where the ranges end.
    """
    x, y = F.col("distance"), F.col("travel_minutes")
    order = [F.col("end_time"), F.col("ride_id")]
    s = segmented_scan(with_buckets(samples, ["bucket"], order, bucket_seconds), ["bucket"], order,
                       BUCKET, sums={"__n": F.lit(1).cast("long"), "__sxy": exact(x * y),
                                     "__sxx": exact(x * x)}, inclusive=False)
    slope = _slope(F.col("__n"), F.col("__sxy").cast("double"), F.col("__sxx").cast("double"))
    pred = F.coalesce((slope * x).try_cast("int"), F.lit(-1))
    return s.withColumn("predicted", pred).withColumnRenamed("__n", "samples_before") \
        .drop("__sxy", "__sxx")

"""Domain tables derived from the driver's ``events`` table (see FIXTURES.md §4).

Every view is a pure DataFrame transformation of ``events``; its work grows with
the table.  Literals are doubles so that the DuckDB oracle computes the same
floats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabline.session import ensure_required_conf, table_path

# Fixed fixture parameters (FIXTURES.md §4).
FARE_DROP_MODULUS = 7        # no fare for ride_id % 7 == 0
FARE_SHIFT_MODULUS = 11      # fare time + 5 s for ride_id % 11 == 0
FARE_SHIFT_SECONDS = 5
CAR_GAP = "6 hours"          # gap of car segments on the sparse events data


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_required_conf(spark)
    return spark.read.parquet(table_path(sf_dir, "events"))


def _lon(event_id: Column) -> Column:
    return (F.lit(-74.10) + (event_id % F.lit(500)).cast("double") * F.lit(0.001)).cast("float")


def _lat(user_id: Column) -> Column:
    return (F.lit(40.45) + (user_id % F.lit(150)).cast("double") * F.lit(0.004)).cast("float")


def ride_pairs(events: DataFrame) -> DataFrame:
    """One row per ride: the even event is its START, the odd event its END.

    One hash aggregation (a single shuffle of three narrow columns); the
    output is hash-partitioned by ride_id, which later joins on ride_id reuse.
    """
    even = (F.col("event_id") % 2) == 0
    pairs = (events.select("event_id", "ts", "user_id")
             .groupBy(F.expr("event_id div 2").alias("ride_id"))
             .agg(F.max(F.when(even, F.col("ts"))).alias("start_time"),
                  F.max(F.when(~even, F.col("ts"))).alias("end_time"),
                  F.max(F.when(even, F.col("user_id"))).alias("driver_id"),
                  F.max(F.when(~even, F.col("user_id"))).alias("end_user")))
    pairs = pairs.where(F.col("start_time").isNotNull())
    rid = F.col("ride_id")
    return pairs.select(
        "ride_id", "start_time", "end_time",
        _lon(rid * 2).alias("start_lon"),
        _lat(F.col("driver_id")).alias("start_lat"),
        F.when(F.col("end_time").isNotNull(), _lon(rid * 2 + 1)).alias("end_lon"),
        F.when(F.col("end_time").isNotNull(), _lat(F.col("end_user"))).alias("end_lat"),
        F.lit(1).cast("short").alias("passenger_cnt"),
        F.col("driver_id").alias("taxi_id"),
        "driver_id",
    )


def rides(events: DataFrame) -> DataFrame:
    """START and END rows of every ride (TaxiRide layout)."""
    p = ride_pairs(events)
    r = p.withColumn("is_start", F.explode(F.array(F.lit(True), F.lit(False))))
    r = r.where(F.col("is_start") | F.col("end_time").isNotNull())
    return r.select("ride_id", "is_start", "start_time", "end_time", "start_lon", "start_lat",
                    "end_lon", "end_lat", "passenger_cnt", "taxi_id", "driver_id")


def fares_for_rides(events: DataFrame, some_missing: bool = True) -> DataFrame:
    """One fare per ride, some 5 s off; ``some_missing``: none where ride_id % 7 == 0."""
    rid = F.expr("event_id div 2")
    shift = F.when(rid % FARE_SHIFT_MODULUS == 0,
                   F.make_dt_interval(secs=F.lit(FARE_SHIFT_SECONDS))) \
        .otherwise(F.make_dt_interval(secs=F.lit(0)))
    return (events.where((F.col("event_id") % 2) == 0)
            .where((rid % FARE_DROP_MODULUS != 0) if some_missing else F.lit(True))
            .select(rid.alias("ride_id"),
                    F.col("user_id").alias("taxi_id"),
                    F.col("user_id").alias("driver_id"),
                    (F.col("ts") + shift).alias("start_time"),
                    F.col("event_type").alias("payment_type"),
                    F.col("value").cast("float").alias("tip"),
                    F.lit(0.0).cast("float").alias("tolls"),
                    F.col("value").cast("float").alias("total_fare")))


def fares_by_driver(events: DataFrame) -> DataFrame:
    """Every event as a fare of its user; tips as exact decimals."""
    return events.select(F.col("event_id").alias("ride_id"),
                         F.col("user_id").alias("driver_id"),
                         F.col("ts").alias("start_time"),
                         F.col("value").cast("decimal(18,2)").alias("tip"))


def car_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").alias("car_id"),
                         F.col("event_id").alias("id"),
                         "ts",
                         F.when(F.col("event_type") == "error", F.lit(0.0))
                         .otherwise(F.col("value")).alias("speed"),
                         F.col("value").alias("throttle"))


def customers(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "view").select(
        F.col("ts").alias("ts"), F.col("user_id").alias("customer_id"),
        F.col("event_id").cast("string").alias("customer_info"))


def trades(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "purchase").select(
        F.col("ts").alias("ts"), F.col("user_id").alias("customer_id"),
        F.col("event_id").cast("string").alias("trade_info"))


def points(events: DataFrame) -> DataFrame:
    return events.select("ts", F.col("event_type").alias("key"), "value")


def car_event_lines(events: DataFrame) -> DataFrame:
    """Car events as lines of 23 fields: every third with ``; ``, every fifth without a speed,
    every seventh without coordinates, every thirteenth cut short (a reject)."""
    e = car_events(events)
    one = lambda c: F.col(c).cast("float").cast("string")                         # noqa: E731
    fields = [F.lit("x")] * 23
    fields[0], fields[1] = F.col("car_id").cast("string"), F.col("id").cast("string")
    fields[7], fields[19] = F.lit(""), F.lit("0.5")
    fields[9] = F.when(F.col("id") % 5 == 0, F.lit("")).otherwise(one("speed"))
    fields[12] = one("throttle")
    place = F.col("id") % 7 == 0
    fields[20] = F.when(place, F.lit("")).otherwise(_lon(F.col("id")).cast("string"))
    fields[21] = F.when(place, F.lit("")).otherwise(_lat(F.col("car_id")).cast("string"))
    fields[22] = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = F.when(F.col("id") % 3 == 0, F.concat_ws("; ", *fields)).otherwise(
        F.concat_ws(",", *fields))
    return e.select(F.when(F.col("id") % 13 == 0, F.regexp_replace(line, "[,;][^,;]*$", ""))
                    .otherwise(line).alias("value"))

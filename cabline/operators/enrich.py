"""Pairing rides with fares: plain (J1) and with expiry / unmatched outputs (J2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.operators.rides import event_time

RIDE_COLS = ["ride_id", "is_start", "start_time", "end_time", "start_lon", "start_lat",
             "end_lon", "end_lat", "passenger_cnt", "taxi_id", "driver_id"]
FARE_COLS = ["ride_id", "taxi_id", "driver_id", "start_time", "payment_type", "tip", "tolls",
             "total_fare"]
FARE_SIDE_COLS = ["fare_ride_id", "fare_taxi_id", "fare_driver_id", "fare_start_time",
                  "payment_type", "tip", "tolls", "total_fare"]
MATCHED, UNMATCHED_RIDE, UNMATCHED_FARE = "matched", "unmatched_ride", "unmatched_fare"


def _fare_side(fares: DataFrame) -> DataFrame:
    """Fare columns renamed so they can sit next to the ride's columns."""
    return fares.select(F.col("ride_id").alias("fare_ride_id"),
                        F.col("taxi_id").alias("fare_taxi_id"),
                        F.col("driver_id").alias("fare_driver_id"),
                        F.col("start_time").alias("fare_start_time"),
                        "payment_type", "tip", "tolls", "total_fare")


def latest_per_ride(df: DataFrame, time_col: str, key: str = "ride_id") -> DataFrame:
    """One row per non-null key: the one with the greatest event time (then greatest row).

    A grouped ``max_by`` rather than a per-key window: it is combined on the
    map side, so even a key holding a third of the rows is reduced before the
    shuffle, and its hash partitioning on the key is reused by the join.
    Rows with a null key are not returned (a null id is no id, and no join
    pairs it); callers that must keep them add them back themselves.
    """
    others = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*[F.col(c) for c in others]),
                    F.struct(F.col(time_col), *[F.col(c) for c in others if c != time_col]))
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("__row"))
            .select(key, *[F.col(f"__row.{c}").alias(c) for c in others]))


def _check_dedupe(dedupe: str) -> None:
    if dedupe != "latest":
        raise ValueError(f"unknown dedupe mode {dedupe!r}: batch pairing keeps one ride and one "
                         "fare per id ('latest'); joining duplicated ids as they are would pair "
                         "every copy with every other")


def rides_with_fares(rides: DataFrame, fares: DataFrame, dedupe: str = "latest",
                     keep_fare_ids: bool = False) -> DataFrame:
    """(ride, fare) for every START ride that has a fare with the same ride_id.

    The original keeps one waiting element per side and id, so one id never
    pairs many rides with many fares; ``dedupe='latest'`` (the only mode)
    keeps the latest START ride and fare per id before joining.
    ``keep_fare_ids`` also returns the fare's own ``fare_taxi_id`` and
    ``fare_driver_id`` (to print the whole fare record).
    """
    _check_dedupe(dedupe)
    r = latest_per_ride(rides.where(F.col("is_start")), "start_time")
    f = latest_per_ride(fares, "start_time")
    fs = _fare_side(f)
    j = r.join(fs, r["ride_id"] == fs["fare_ride_id"], "inner")
    ids = ["fare_taxi_id", "fare_driver_id"] if keep_fare_ids else []
    return j.select(*[r[c] for c in RIDE_COLS], *ids, "fare_start_time", "payment_type", "tip",
                    "tolls", "total_fare")


def match_with_expiry(rides: DataFrame, fares: DataFrame, max_wait_seconds: int = 0,
                      dedupe: str = "latest") -> DataFrame:
    """Full outer pairing with an ``outcome`` column.

    A ride and a fare with the same ride_id match when their event times are
    at most ``max_wait_seconds`` apart; everything else ends up unmatched
    (``unmatched_ride`` / ``unmatched_fare``), i.e. the rows the original
    job routes to its side outputs when the watermark passes them.
    """
    r = rides.withColumn("ride_time", event_time())
    f = _fare_side(fares)
    _check_dedupe(dedupe)
    # rows without an id can match nothing: they go out unmatched, added after
    # the join so that the join keeps the dedupe's partitioning (no branch for
    # inputs whose schema rules out a missing id)
    no_id = []
    if r.schema["ride_id"].nullable:
        no_id.append(r.where(F.col("ride_id").isNull()).select(
            F.lit(None).cast("long").alias("key_ride_id"),
            F.lit(UNMATCHED_RIDE).alias("outcome"), *RIDE_COLS, "ride_time"))
    if f.schema["fare_ride_id"].nullable:
        no_id.append(f.where(F.col("fare_ride_id").isNull()).select(
            F.lit(None).cast("long").alias("key_ride_id"),
            F.lit(UNMATCHED_FARE).alias("outcome"), *FARE_SIDE_COLS))
    r = latest_per_ride(r, "ride_time")
    f = latest_per_ride(f, "fare_start_time", key="fare_ride_id")
    wait = F.make_dt_interval(secs=F.lit(int(max_wait_seconds)))
    cond = ((r["ride_id"] == f["fare_ride_id"])
            & (r["ride_time"] >= f["fare_start_time"] - wait)
            & (r["ride_time"] <= f["fare_start_time"] + wait))
    j = r.join(f, cond, "full_outer")
    has_ride = r["ride_id"].isNotNull()
    has_fare = f["fare_ride_id"].isNotNull()
    outcome = (F.when(has_ride & has_fare, F.lit(MATCHED))
               .when(has_ride, F.lit(UNMATCHED_RIDE)).otherwise(F.lit(UNMATCHED_FARE)))
    out = j.select(F.coalesce(r["ride_id"], f["fare_ride_id"]).alias("key_ride_id"),
                   outcome.alias("outcome"),
                   *[r[c] for c in RIDE_COLS], r["ride_time"], *[f[c] for c in FARE_SIDE_COLS])
    for extra in no_id:
        out = out.unionByName(extra, allowMissingColumns=True)
    return out


def matched(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("outcome") == MATCHED)


def unmatched_rides(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("outcome") == UNMATCHED_RIDE).select(*RIDE_COLS, "ride_time")


def unmatched_fares(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("outcome") == UNMATCHED_FARE).select(
        F.col("fare_ride_id").alias("ride_id"), F.col("fare_taxi_id").alias("taxi_id"),
        F.col("fare_driver_id").alias("driver_id"), F.col("fare_start_time").alias("start_time"),
        "payment_type", "tip", "tolls", "total_fare")

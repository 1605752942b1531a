"""The jobs as streaming queries.

The batch operators are reused where Spark's streaming planner supports them
(filters, windowed aggregates, stream-stream joins); ordered per-key logic
uses ``transformWithStateInPandas`` with event-time timers.  Every input gets
its watermark before it is joined or unioned, so the slower input holds the
query's watermark (minimum policy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.operators import enrich, rides as R, segments, tips, traveltime
from cabline.operators.scan import exact
from cabline.schemas import FARE, RIDE
from cabline.streaming import ordered, processors
from cabline.streaming.sources import (CAR_EVENT_DELAY, HOURLY_TIPS_DELAY, RIDE_CLEANSING_DELAY,
                                       RIDES_AND_FARES_DELAY, with_watermark)


def ride_cleansing(rides: DataFrame, delay: str = RIDE_CLEANSING_DELAY) -> DataFrame:
    r = R.with_event_time(rides)
    return R.cleanse(with_watermark(r, "event_time", delay))


def hourly_tips(fares: DataFrame, delay: str = HOURLY_TIPS_DELAY) -> DataFrame:
    """(window end, driver, tips), emitted once the watermark closes the hour."""
    f = with_watermark(fares, "start_time", delay)
    return tips.label_with_window_end(tips.hourly_tips(f))


def hourly_max_tips(fares: DataFrame, delay: str = HOURLY_TIPS_DELAY) -> DataFrame:
    """Cascaded windows: per-driver hourly sums, then the best driver per hour."""
    f = with_watermark(fares, "start_time", delay)
    return tips.label_with_window_end(tips.hourly_max(tips.hourly_tips(f)))


def _dedupe_stream(df: DataFrame, dedupe: str, key: str = "ride_id") -> DataFrame:
    """One element per id, like the original's single waiting element per key.

    ``'first'`` (the only mode) keeps the first arrival, with state bounded by
    the watermark, so a duplicated id never pairs every copy with every partner.
    A null id is no id: its rows pass unchanged, as in the batch jobs.
    """
    if dedupe != "first":
        raise ValueError(f"unknown dedupe mode {dedupe!r}: streams keep the first ride and "
                         "fare per id ('first')")
    known = df.where(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return known.unionByName(df.where(F.col(key).isNull()))


def rides_with_fares(rides: DataFrame, fares: DataFrame, delay: str = RIDES_AND_FARES_DELAY,
                     max_gap: str | None = None, dedupe: str = "first",
                     keep_fare_ids: bool = False) -> DataFrame:
    """Stream-stream inner join on ride_id: every pair, however far apart in time.

    Waiting rows stay in state, as in the original job.  Where ride and fare are
    known to be close, ``max_gap`` (an interval) lets their state go; pairs
    further apart than that are then never joined.
    """
    r = _dedupe_stream(with_watermark(R.start_events(rides), "start_time", delay), dedupe)
    f = _dedupe_stream(with_watermark(fares, "start_time", delay), dedupe)
    fs = enrich._fare_side(f)
    cond = r["ride_id"] == fs["fare_ride_id"]
    if max_gap:
        gap = F.expr(f"INTERVAL {max_gap}")
        cond = (cond & (fs["fare_start_time"] >= r["start_time"] - gap)
                & (fs["fare_start_time"] <= r["start_time"] + gap))
    j = r.join(fs, cond, "inner")
    ids = ["fare_taxi_id", "fare_driver_id"] if keep_fare_ids else []
    return j.select(*[r[c] for c in enrich.RIDE_COLS], *ids, "fare_start_time", "payment_type",
                    "tip", "tolls", "total_fare")


def rides_with_fares_expiring(rides: DataFrame, fares: DataFrame, max_gap_seconds: int,
                              delay: str = RIDES_AND_FARES_DELAY) -> DataFrame:
    """:func:`rides_with_fares` with state that expires: a ride or fare whose partner isn't within
    ``max_gap_seconds`` leaves the state once the watermark rules the partner out, and comes
    out unmatched instead of being lost.  Columns as :func:`expiring_pairs_join`."""
    return expiring_pairs_join(R.start_events(rides), fares, max_gap_seconds, delay,
                               loss_modulus=None)


def expiring_pairs_join(rides: DataFrame, fares: DataFrame, max_wait_seconds: int = 0,
                        delay: str = "0 seconds", loss_modulus: int | None = 1000,
                        dedupe: str = "first") -> DataFrame:
    """Variant (a): full outer stream-stream join with a time bound.

    Unmatched rows come out once the watermark passes them, with the same
    ``outcome`` column and the same whole ride and fare columns as the batch job;
    ``fare_time`` repeats ``fare_start_time``.
    """
    r = rides if loss_modulus is None else R.start_events_with_loss(rides, loss_modulus)
    r = _dedupe_stream(with_watermark(
        R.with_event_time(r).withColumnRenamed("event_time", "ride_time"), "ride_time", delay),
        dedupe)
    f = _dedupe_stream(with_watermark(fares, "start_time", delay), dedupe)
    # marks of presence: a row without an id is still a ride or a fare
    r = r.withColumn("__ride", F.lit(True))
    fs = enrich._fare_side(f).withColumn("__fare", F.lit(True))
    wait = F.expr(f"INTERVAL {int(max_wait_seconds)} SECONDS")
    cond = ((r["ride_id"] == fs["fare_ride_id"])
            & (r["ride_time"] >= fs["fare_start_time"] - wait)
            & (r["ride_time"] <= fs["fare_start_time"] + wait))
    j = r.join(fs, cond, "full_outer")
    has_ride, has_fare = F.col("__ride").isNotNull(), F.col("__fare").isNotNull()
    outcome = (F.when(has_ride & has_fare, F.lit(enrich.MATCHED))
               .when(has_ride, F.lit(enrich.UNMATCHED_RIDE)).otherwise(F.lit(enrich.UNMATCHED_FARE)))
    shared = {"ride_id": "fare_ride_id", "driver_id": "fare_driver_id"}
    return j.select(outcome.alias("outcome"), r["ride_time"],
                    fs["fare_start_time"].alias("fare_time"),
                    *[F.when(has_ride, r[c]).otherwise(fs[shared[c]]).alias(c) if c in shared
                      else r[c] for c in enrich.RIDE_COLS], *[fs[c] for c in enrich.FARE_SIDE_COLS])


_RECORD_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _waiting_side(df: DataFrame, side: str, time: str, delay: str, dedupe: str) -> DataFrame:
    """(ride_id, side, t, t_us, record): each row with all its columns as one text."""
    d = with_watermark(df.withColumn("t", F.col(time)), "t", delay)
    names = enrich.RIDE_COLS if side == "R" else enrich.FARE_COLS
    columns = [F.col(c).cast("timestamp").alias(c) if c.endswith("_time") else F.col(c) for c in names]
    rows = d.select("ride_id", F.lit(side).alias("side"), "t",
                    F.unix_micros("t").alias("t_us"),
                    F.to_json(F.struct(*columns), _RECORD_OPTIONS).alias("record"))
    return _dedupe_stream(rows, dedupe)


def expiring_pairs_stateful(rides: DataFrame, fares: DataFrame, max_wait_seconds: int = 0,
                            delay: str = "0 seconds", loss_modulus: int | None = 1000,
                            dedupe: str = "first") -> DataFrame:
    """Variant (b): keyed state + event-time timers (transformWithState); whole ride and
    fare columns as :func:`expiring_pairs_join`.

    With ``dedupe='first'`` a key's group holds at most one ride and one fare
    per micro-batch, whatever the number of copies of an id.
    """
    r = rides if loss_modulus is None else R.start_events_with_loss(rides, loss_modulus)
    u = _waiting_side(R.with_event_time(r), "R", "event_time", delay, dedupe).unionByName(
        _waiting_side(fares, "F", "start_time", delay, dedupe))
    # rows without an id have no partner: they don't wait
    is_ride = F.col("side") == "R"
    lone = u.where(F.col("ride_id").isNull()).select(
        "ride_id", F.when(is_ride, F.lit(enrich.UNMATCHED_RIDE))
        .otherwise(F.lit(enrich.UNMATCHED_FARE)).alias("outcome"),
        F.when(is_ride, F.col("t")).alias("ride_time"),
        F.when(~is_ride, F.col("t")).alias("fare_time"),
        F.when(is_ride, F.col("record")).alias("ride"),
        F.when(~is_ride, F.col("record")).alias("fare"))
    out = u.where(F.col("ride_id").isNotNull()).groupBy("ride_id").transformWithStateInPandas(
        statefulProcessor=processors.ExpiringPairProcessor(max_wait_seconds),
        outputStructType=processors.EXPIRING_OUTPUT, outputMode="Append",
        timeMode="EventTime").unionByName(lone)
    out = out.withColumns({"r": F.from_json("ride", RIDE, _RECORD_OPTIONS),
                           "f": F.from_json("fare", FARE, _RECORD_OPTIONS)})
    fare = {"ride_id": "fare_ride_id", "taxi_id": "fare_taxi_id", "driver_id": "fare_driver_id",
            "start_time": "fare_start_time"}
    shared = {"ride_id": F.col("ride_id"), "driver_id": F.coalesce("r.driver_id", "f.driver_id")}
    return out.select("outcome", "ride_time", "fare_time",
                      *[shared.get(c, F.col(f"r.{c}")).alias(c) for c in enrich.RIDE_COLS],
                      *[F.col(f"f.{c}").alias(fare.get(c, c)) for c in enrich.FARE_COLS])


def _micros(col: str):
    return F.unix_micros(F.col(col).cast("timestamp")).alias("t_us")


def trades_asof_customers(trades: DataFrame, customers: DataFrame, key: str = "customer_id",
                          delay: str = "0 seconds",
                          bucket_seconds: float = ordered.BUCKET_SECONDS) -> DataFrame:
    """As-of enrichment: a trade waits for the watermark to pass its time bucket, then gets
    the latest customer record at or before it.

    As in the batch job, records without an id or a time match nothing, and a trade without
    a time has no customer; it doesn't wait."""
    t = trades.select(F.col(key).cast("long").alias("customer_id"), F.lit(1).alias("side"), "ts",
                      F.col("trade_info").alias("info"))
    c = customers.select(F.col(key).cast("long").alias("customer_id"), F.lit(0).alias("side"), "ts",
                         F.col("customer_info").alias("info")).where(F.col(key).isNotNull())
    t, c = (with_watermark(x, "ts", delay) for x in (t, c))
    u = t.unionByName(c).where(F.col("ts").isNotNull()).withColumn("t_us", _micros("ts"))
    none = F.lit(None)
    lone = t.where(F.col("ts").isNull()).select(
        "customer_id", F.col("ts").alias("trade_ts"), F.col("info").alias("trade_info"),
        none.cast("timestamp").alias("customer_ts"), none.cast("string").alias("customer_info"))
    return u.groupBy("customer_id").transformWithStateInPandas(
        statefulProcessor=ordered.AsofProcessor(bucket_seconds),
        outputStructType=ordered.ASOF_OUTPUT, outputMode="Append",
        timeMode="EventTime").unionByName(lone)


def ride_sequence(rides: DataFrame, delay: str = RIDE_CLEANSING_DELAY, key: str = "driver_id",
                  bucket_seconds: float = ordered.BUCKET_SECONDS) -> DataFrame:
    """Position of each ride record in its driver's ride order, as the batch ``ride_sequence``:
    rows wait until the watermark has passed their bucket.  Rows without an event time have
    no place in a stream's order and are left out."""
    r = with_watermark(R.with_event_time(rides), "event_time", delay)
    r = r.where(F.col("event_time").isNotNull()).select(
        F.col(key).cast("long").alias("driver_id"), "ride_id", "event_time", _micros("event_time"),
        F.when(F.col("is_start"), 0).otherwise(1).alias("end"))
    return r.groupBy("driver_id").transformWithStateInPandas(
        statefulProcessor=ordered.RideOrderProcessor(bucket_seconds),
        outputStructType=ordered.RIDE_ORDER_OUTPUT, outputMode="Append", timeMode="EventTime")


def interval_micros(interval: str) -> int:
    """``'15 seconds'``, ``'6 hours'`` ... as microseconds."""
    units = {"millisecond": 1000, "second": 10 ** 6, "minute": 60 * 10 ** 6,
             "hour": 3600 * 10 ** 6, "day": 86400 * 10 ** 6}
    try:
        number, unit = interval.split()
        return int(number) * units[unit.rstrip("s")]
    except (KeyError, ValueError):
        raise ValueError(f"not a '<number> <unit>' interval: {interval!r}") from None


def _segment_rows(out: DataFrame, key: str) -> DataFrame:
    return segments.with_label(out.withColumnRenamed("key", key))


def gap_segments(car_events: DataFrame, gap: str = "15 seconds", key: str = "car_id",
                 delay: str = CAR_EVENT_DELAY) -> DataFrame:
    """Gap segments per vehicle; a segment is emitted when the watermark closes it.

    Events are first combined per (vehicle, gap-wide window), in part before the shuffle, so
    a vehicle with a third of all events sends one row per task and window; then each
    vehicle's partials are merged in a state that holds its open segment alone."""
    micros = interval_micros(gap)
    e = with_watermark(car_events, "ts", delay)
    x = F.col("throttle").cast("double")
    parts = e.groupBy(F.col(key).alias("key"), F.window("ts", gap).alias("window")).agg(
        F.min(F.unix_micros("ts")).alias("first_us"), F.max(F.unix_micros("ts")).alias("last_us"),
        F.count(F.lit(1)).alias("rows"), F.max("speed").cast("double").alias("speed"),
        F.count(x).alias("n"), F.avg(x).alias("mean"),
        (F.var_pop(x) * F.count(x)).alias("dev"))
    parts = parts.withColumn("closed", F.window_time("window")).drop("window")
    out = parts.groupBy("key").transformWithStateInPandas(
        statefulProcessor=ordered.GapSegmentProcessor(micros),
        outputStructType=ordered.segment_output(car_events.schema[key].dataType),
        outputMode="Append", timeMode="EventTime")
    return _segment_rows(out, key)


def stopped_segments(car_events: DataFrame, key: str = "car_id", delay: str = CAR_EVENT_DELAY,
                     bucket_seconds: float = ordered.BUCKET_SECONDS) -> DataFrame:
    """Segments between stops, emitted when the stop that ends them is released.  Disorder
    within ``delay`` is put right; the segment after a vehicle's last stop stays open (the
    batch job, which knows the end of its input, returns it too)."""
    e = with_watermark(car_events, "ts", delay).where(F.col("ts").isNotNull())
    stop = F.coalesce(F.col("speed") == F.lit(0.0), F.lit(False))
    rows = e.select(F.col(key).alias("key"), "ts", _micros("ts"),
                    F.when(stop, 0).otherwise(1).alias("moving"),
                    F.col("speed").cast("double").alias("speed"),
                    F.col("throttle").cast("double").alias("throttle"))
    out = rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=ordered.StoppedSegmentProcessor(bucket_seconds),
        outputStructType=ordered.segment_output(car_events.schema[key].dataType),
        outputMode="Append", timeMode="EventTime")
    return _segment_rows(out, key)


def running_predictions(samples: DataFrame, delay: str = RIDES_AND_FARES_DELAY,
                        bucket_seconds: float = ordered.BUCKET_SECONDS) -> DataFrame:
    """Predict each finished ride from its direction's rides that finished before it, then
    learn from it: the batch ``running_predictions`` over a stream of travel samples.

    The order of a direction is inherently sequential, so its rows pass one task; rows of a
    direction wait in buckets and only three numbers per direction stay."""
    s = with_watermark(samples, "end_time", delay).where(F.col("end_time").isNotNull())
    x, y = F.col("distance"), F.col("travel_minutes")

    def whole(v):           # a decimal of 18 places as a whole number
        units = F.lit(ordered.UNIT).cast("decimal(19,0)")
        return (exact(v) * units).cast("decimal(38,0)").cast("string")

    rows = s.select(F.col("bucket").cast("int").alias("bucket"), "ride_id", "end_time",
                    _micros("end_time"), "distance", whole(x * y).alias("xy"),
                    whole(x * x).alias("xx"))
    return rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=ordered.PredictionProcessor(traveltime.MIN_POINTS,
                                                      traveltime.MIN_SUM_XX, bucket_seconds),
        outputStructType=ordered.PREDICTION_OUTPUT, outputMode="Append", timeMode="EventTime")

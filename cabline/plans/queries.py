"""Named driver queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Each reads ``events`` in full and builds its domain view (FIXTURES.md §4)
with Spark, then runs the job.  Computed columns carry the same names as in
``oracle.py``; doubles that depend on summation order are rounded to 6 places
in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabline.functions.geo import cells_on_way, direction, distance, distance_to_point
from cabline.functions.sql import register_functions
from cabline.operators import asof, cells, enrich, points, rides, segments, tips, traveltime
from cabline.sinks import render
from cabline.sources import codec, files, fixtures as fx

ROUND = 6
CAR_GAP_SECONDS = 6 * 3600


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.load_events(spark, sf_dir)


def q_ride_cleansing(spark, sf_dir):
    return rides.cleanse(fx.rides(_events(spark, sf_dir)))


def q_ride_event_order(spark, sf_dir):
    r = rides.ride_sequence(fx.rides(_events(spark, sf_dir)))
    return r.select("ride_id", "is_start", "driver_id", "event_time", "seq")


def _hourly_tips(spark, sf_dir):
    return tips.hourly_tips(fx.fares_by_driver(_events(spark, sf_dir)))


def q_hourly_tips(spark, sf_dir):
    return tips.label_with_window_end(_hourly_tips(spark, sf_dir))


def q_hourly_max_tips(spark, sf_dir):
    return tips.label_with_window_end(tips.hourly_max(_hourly_tips(spark, sf_dir)))


def q_rides_with_fares(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return enrich.rides_with_fares(fx.rides(ev), fx.fares_for_rides(ev, some_missing=False))


def _expiring(spark, sf_dir):
    ev = _events(spark, sf_dir)
    r = rides.start_events_with_loss(fx.rides(ev), 1000)
    return enrich.match_with_expiry(r, fx.fares_for_rides(ev), max_wait_seconds=0)


def q_expiring_matched(spark, sf_dir):
    m = enrich.matched(_expiring(spark, sf_dir))
    return m.select("ride_id", "driver_id", "ride_time", "fare_start_time", "payment_type", "tip",
                    "total_fare")


def q_unmatched_rides(spark, sf_dir):
    return enrich.unmatched_rides(_expiring(spark, sf_dir)).select(
        "ride_id", "driver_id", "ride_time", "start_lon", "start_lat")


def q_unmatched_fares(spark, sf_dir):
    return enrich.unmatched_fares(_expiring(spark, sf_dir)).select(
        "ride_id", "driver_id", "start_time", "tip")


def q_trades_asof_customers(spark, sf_dir):
    ev = _events(spark, sf_dir)
    out = asof.asof_enrich(fx.trades(ev), fx.customers(ev))
    return out.select("customer_id", F.col("ts").alias("trade_ts"), "trade_info", "customer_ts",
                      "customer_info")


def _segment_output(df):
    e = F.round("erraticness", ROUND)
    return df.select("car_id", "start_time", "length", "max_speed", e.alias("erraticness"),
                     segments.erraticness_label(e).alias("label"))


def q_gap_segments(spark, sf_dir):
    ce = fx.car_events(_events(spark, sf_dir))
    return _segment_output(segments.gap_segments(ce, gap_seconds=CAR_GAP_SECONDS))


def q_stopped_segments(spark, sf_dir):
    ce = fx.car_events(_events(spark, sf_dir))
    return _segment_output(segments.stopped_segments(ce))


def q_rides_per_cell(spark, sf_dir):
    return cells.rides_per_cell(fx.rides(_events(spark, sf_dir)))


def q_cell_traffic(spark, sf_dir):
    return cells.cell_traffic(fx.ride_pairs(_events(spark, sf_dir)))


def q_ride_distance_direction(spark, sf_dir):
    p = fx.ride_pairs(_events(spark, sf_dir)).where(F.col("end_time").isNotNull())
    return p.select("ride_id",
                    F.round(distance("start_lon", "start_lat", "end_lon", "end_lat"),
                            ROUND).alias("distance"),
                    direction("start_lon", "start_lat", "end_lon", "end_lat").alias("direction"))


def _samples(spark, sf_dir):
    return traveltime.travel_samples(fx.ride_pairs(_events(spark, sf_dir)))


def q_travel_time_model(spark, sf_dir):
    m = traveltime.fit_model(_samples(spark, sf_dir))
    return m.select("bucket", "n", F.round("slope", ROUND).alias("slope"))


def q_travel_time_predictions(spark, sf_dir):
    p = traveltime.running_predictions(_samples(spark, sf_dir))
    return p.select("ride_id", "bucket", "samples_before", "predicted")


def q_measurement_points(spark, sf_dir):
    return points.line_protocol(fx.points(_events(spark, sf_dir)), measurement="events")


def q_ride_messages_roundtrip(spark, sf_dir):
    r = fx.rides(_events(spark, sf_dir))
    decoded = codec.decode_rides(codec.encode_rides(r))
    return decoded.withColumns({"start_time": F.col("start_time").cast("timestamp_ntz"),
                                "end_time": F.col("end_time").cast("timestamp_ntz")})


def q_sql_functions(spark, sf_dir):
    register_functions(spark)
    return spark.sql(
        "SELECT ride_id, in_nyc, cell_id, to_coords(cell_id).lon AS lon, "
        "to_coords(cell_id).lat AS lat FROM (SELECT ride_id, is_in_nyc(start_lon, start_lat) "
        "AS in_nyc, to_cell_id(start_lon, start_lat) AS cell_id FROM {pairs})",
        pairs=fx.ride_pairs(_events(spark, sf_dir)))


def q_travel_time_scored(spark, sf_dir):
    samples = _samples(spark, sf_dir)
    model = traveltime.fit_model(samples).withColumn("slope", F.round("slope", ROUND))
    return traveltime.predict(model, samples).select("ride_id", "bucket", "predicted")


def _fare_lines(spark, sf_dir):
    return render.fares(fx.fares_for_rides(_events(spark, sf_dir), some_missing=False))


def q_fare_lines_roundtrip(spark, sf_dir):
    parsed = codec.parse_fares(_fare_lines(spark, sf_dir))
    return parsed.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


def q_line_rejects(spark, sf_dir):
    """Every fifth fare line is cut short, every seventh has an unreadable tip."""
    line, ride = F.col("value"), F.substring_index("value", ",", 1).cast("long")
    broken = F.when(ride % 5 == 0, F.substring_index(line, ",", 6)).when(
        ride % 7 == 0, F.concat(F.substring_index(line, ",", 5), F.lit(",?,0.0,1.0"))).otherwise(line)
    _, bad = codec.parse_fares(_fare_lines(spark, sf_dir).select(broken.alias("value")),
                               mode="quarantine")
    return bad.select(F.substring_index("line", ",", 1).cast("long").alias("ride_id"),
                      F.size(F.split("line", ",")).alias("fields"))


def q_ride_distance_to_point(spark, sf_dir):
    r = fx.rides(_events(spark, sf_dir))
    d = distance_to_point("is_start", "start_lon", "start_lat", "end_lon", "end_lat",
                          F.lit(-73.9), F.lit(40.75))
    return r.select("ride_id", "is_start", F.round(d, ROUND).alias("distance"))


def q_ride_cells_on_way(spark, sf_dir):
    p = fx.ride_pairs(_events(spark, sf_dir)).where(F.col("end_time").isNotNull())
    cells_ = cells_on_way("start_lon", "start_lat", "end_lon", "end_lat")
    return p.select("ride_id", F.explode(cells_).alias("cell_id"))


def q_record_lines(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return render.trades(fx.trades(ev)).unionByName(render.customers(fx.customers(ev)))


def q_point_projections(spark, sf_dir):
    p = fx.points(_events(spark, sf_dir))
    return points.with_key_and_value(p, F.upper("key"), F.col("value") * 2)


def _car_event_records(spark, sf_dir):
    return codec.parse_car_events(fx.car_event_lines(_events(spark, sf_dir)), mode="quarantine")


def q_car_event_lines(spark, sf_dir):
    """Car events read from their lines, with both separators, empty floats and rejects."""
    good, bad = _car_event_records(spark, sf_dir)
    rejects = bad.select(F.regexp_extract("line", r"^[^,;]*[,;]\s*([^,;]*)", 1).alias("id"))
    return good.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn(
        "accepted", F.lit(True)).unionByName(rejects.withColumn("accepted", F.lit(False)),
                                             allowMissingColumns=True)


def q_car_event_renderings(spark, sf_dir):
    good, _ = _car_event_records(spark, sf_dir)
    return render.car_events(good)


def q_segment_lines(spark, sf_dir):
    return render.segments(q_gap_segments(spark, sf_dir))


def q_enriched_trade_lines(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return render.enriched_trades(asof.asof_enrich(fx.trades(ev), fx.customers(ev)))


def q_ride_lines(spark, sf_dir):
    """Rides read from their lines: every fifth is cut short, every seventh has an unknown tag."""
    line = F.col("value")
    ride = F.substring_index("value", ",", 1).cast("long")
    broken = F.when(ride % 5 == 0, F.substring_index(line, ",", 10)).when(
        ride % 7 == 0, F.regexp_replace(line, ",(START|END),", ",MIDDLE,")).otherwise(line)
    lines = render.rides(fx.rides(_events(spark, sf_dir))).select(broken.alias("value"))
    good, bad = codec.parse_rides(lines, mode="quarantine")
    good = good.select("ride_id", "is_start", F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                       F.col("end_time").cast("timestamp_ntz").alias("end_time"), "start_lon",
                       "end_lat", F.lit(True).alias("accepted"))
    rejects = bad.select(F.substring_index("line", ",", 1).cast("long").alias("ride_id"),
                         F.lit(False).alias("accepted"))
    return good.unionByName(rejects, allowMissingColumns=True)


def q_keyed_records(spark, sf_dir):
    """Trades and customers written as CSV lines and read back; every ninth line has no info."""
    ev, out = _events(spark, sf_dir), None
    for kind, records in (("trades", fx.trades(ev)), ("customers", fx.customers(ev))):
        lines = files.keyed_event_lines(records, kind)
        info = F.substring_index("value", ",", -1).cast("long")
        lines = lines.select(F.when(info % 9 == 0, F.substring_index("value", ",", 2))
                             .otherwise(F.col("value")).alias("value"))
        good, bad = files.parse_keyed_events(lines, kind, mode="quarantine")
        good = good.select(F.lit(kind).alias("kind"), "customer_id",
                           F.col(good.columns[2]).alias("info"),
                           F.col("ts").cast("timestamp_ntz").alias("ts"))
        bad = bad.select(F.lit(kind).alias("kind"),
                         F.element_at(F.split("line", ","), 2).cast("long").alias("customer_id"))
        both = good.unionByName(bad, allowMissingColumns=True)
        out = both if out is None else out.unionByName(both)
    return out


QUERIES = {
    "ride_cleansing": q_ride_cleansing,
    "ride_event_order": q_ride_event_order,
    "hourly_tips": q_hourly_tips,
    "hourly_max_tips": q_hourly_max_tips,
    "rides_with_fares": q_rides_with_fares,
    "expiring_matched": q_expiring_matched,
    "unmatched_rides": q_unmatched_rides,
    "unmatched_fares": q_unmatched_fares,
    "trades_asof_customers": q_trades_asof_customers,
    "gap_segments": q_gap_segments,
    "stopped_segments": q_stopped_segments,
    "rides_per_cell": q_rides_per_cell,
    "cell_traffic": q_cell_traffic,
    "ride_distance_direction": q_ride_distance_direction,
    "travel_time_model": q_travel_time_model,
    "travel_time_predictions": q_travel_time_predictions,
    "measurement_points": q_measurement_points,
    "ride_messages_roundtrip": q_ride_messages_roundtrip,
    "sql_functions": q_sql_functions,
    "travel_time_scored": q_travel_time_scored,
    "fare_lines_roundtrip": q_fare_lines_roundtrip,
    "line_rejects": q_line_rejects,
    "ride_distance_to_point": q_ride_distance_to_point,
    "ride_cells_on_way": q_ride_cells_on_way,
    "record_lines": q_record_lines,
    "point_projections": q_point_projections,
    "car_event_lines": q_car_event_lines,
    "car_event_renderings": q_car_event_renderings,
    "segment_lines": q_segment_lines,
    "enriched_trade_lines": q_enriched_trade_lines,
    "ride_lines": q_ride_lines,
    "keyed_records": q_keyed_records,
}


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship: best driver of every hour (hourly tips cascaded into an hourly max)."""
    return q_hourly_max_tips(spark, sf_dir)

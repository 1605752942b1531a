"""File sources and sinks: gzip text in, text / routed / measurement lines out."""

import gzip
import os

from pyspark.sql import functions as F

from cabline import sinks
from cabline.operators import enrich, points, rides as R
from cabline.sources import files, fixtures as fx
from cabline.streaming import jobs
from cabline.streaming.sources import ride_stream
from tests.conftest import SF_SMALL

LINES = [
    "1,START,2013-01-01 00:00:00,2013-01-01 00:10:00,-73.9,40.7,-73.8,40.8,1,10,20",
    "2,START,2013-01-01 00:01:00,2013-01-01 00:09:00,-74.2,40.7,-73.8,40.8,1,10,21",
    "1,END,2013-01-01 00:10:00,2013-01-01 00:00:00,-73.9,40.7,-73.8,40.8,1,10,20",
]


def _gz(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_read_gzip_rides_and_cleanse(spark, scratch):
    p = os.path.join(scratch, "rides", "rides.gz")
    _gz(p, LINES)
    r = files.read_rides(spark, p)
    assert r.count() == 3
    assert sorted(x.ride_id for x in R.cleanse(r).collect()) == [1, 1]


def test_stream_cleansing_from_text_files(spark, scratch):
    d = os.path.join(scratch, "in")
    _gz(os.path.join(d, "a.gz"), LINES)
    s = jobs.ride_cleansing(ride_stream(spark, d))
    q = (s.writeStream.format("memory").queryName("clean_stream").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(x.ride_id for x in spark.sql("SELECT * FROM clean_stream").collect()) == [1, 1]


def test_keyed_event_tables(spark, scratch):
    p = os.path.join(scratch, "custs.csv")
    with open(p, "w") as f:
        f.write("0,0,Customer data @ 0\n500,0,Customer data @ 500\n")
    c = files.read_keyed_events(spark, p, "customers")
    assert [str(x.ts) for x in c.orderBy("ts").collect()] == \
        ["1970-01-01 00:00:00", "1970-01-01 00:00:00.500000"]


def test_text_sink_and_router(spark, scratch):
    ev = fx.load_events(spark, SF_SMALL)
    pairs = enrich.match_with_expiry(R.start_events_with_loss(fx.rides(ev), 1000),
                                     fx.fares_for_rides(ev))
    outs = {}

    def writer(name):
        def w(df, batch_id):
            path = os.path.join(scratch, name)
            sinks.write_text(df.select(F.col("key_ride_id").cast("string")), path)
            outs[name] = path
        return w

    route = sinks.route_outcomes({o: writer(o) for o in
                                  ["matched", "unmatched_ride", "unmatched_fare"]})
    route(pairs, 0)
    counts = {k: spark.read.text(v).count() for k, v in outs.items()}
    assert counts == {o: pairs.where(F.col("outcome") == o).count() for o in counts}
    assert sum(counts.values()) == pairs.count()


def test_measurement_points_go_to_their_database(spark, scratch):
    pts = fx.points(fx.load_events(spark, SF_SMALL))
    sinks.write_points(pts, scratch, measurement="events")           # default database
    sinks.write_points(pts, scratch, measurement="events", db="metrics")
    for db in ("sineWave", "metrics"):
        lines = spark.read.text(os.path.join(scratch, db))
        assert lines.count() == pts.count()
    one = points.line_protocol(
        spark.createDataFrame([("2024-01-01 00:00:01", "a b,c", 1.5)], "t string, key string, value double")
        .select(F.col("t").cast("timestamp").alias("ts"), "key", "value"), "my m").first().line
    assert one == "my\\ m,key=a\\ b\\,c value=1.5 1704067201000"


def test_point_projections(spark):
    pts = fx.points(fx.load_events(spark, SF_SMALL))
    doubled = points.with_key_and_value(pts, F.upper("key"), F.col("value") * 2)
    r = doubled.first()
    assert r.key == r.key.upper()
    assert points.with_value(pts, F.lit(1.0)).agg(F.sum("value")).first()[0] == pts.count()


def test_text_renderings(spark):
    from cabline.sinks import render
    t = spark.createDataFrame([(1500, 0, "trade-3", "Customer data @ 1500")],
                              "ms long, customer_id long, trade_info string, customer_info string") \
        .withColumn("ts", F.timestamp_millis("ms"))
    assert render.trades(t).first().value == "Trade(1500) trade-3"
    assert render.customers(t).first().value == "Customer(1500) Customer data @ 1500"
    assert render.enriched_trades(t).first().value == "EnrichedTrade(1500) Customer data @ 1500"
    seg = spark.createDataFrame([(1000, 3, 88, "busy")], "ms long, length long, max_speed int, label string") \
        .withColumn("start_time", F.timestamp_millis("ms"))
    assert render.segments(seg).first().value == "1000,3 events,88 kph,busy"
    car = spark.createDataFrame([("e1", 2000, 1.5, 2.5, 50.0, 3.0, 4.0)],
                                "id string, ms long, longitude float, latitude float, speed float, "
                                "throttle float, engineload float").withColumn("ts", F.timestamp_millis("ms"))
    assert render.car_events(car).first().value == "e1,2000,1.5,2.5,50.0,3.0,4.0"
    pts = spark.createDataFrame([(5, "k", 2.0)], "ms long, key string, value double") \
        .withColumn("ts", F.timestamp_millis("ms"))
    assert render.keyed_points(pts).first().value == "5,k,2.0"
    assert render.points(pts).first().value == "DataPoint(timestamp=5, value=2.0)"


def test_hourly_tips_text_stream(spark, scratch):
    from cabline.operators import tips
    from cabline.streaming.sources import parquet_stream
    ev = fx.load_events(spark, SF_SMALL)
    f = fx.fares_by_driver(ev).withColumn("start_time", F.col("start_time").cast("timestamp"))
    src = os.path.join(scratch, "src")
    f.coalesce(1).write.parquet(src)
    out = os.path.join(scratch, "out")
    q = sinks.text_stream(tips.render_tuple(jobs.hourly_tips(parquet_stream(spark, src, f.schema))),
                          out, os.path.join(scratch, "ck"), trigger={"availableNow": True})
    q.awaitTermination(120)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines and all(x.startswith("(2024-01-") and x.endswith(")") for x in lines)


def test_read_car_event_files(spark, scratch):
    fields = [str(i) for i in range(23)]
    fields[0], fields[9], fields[12] = "car-1", "0.0", "4.0"
    fields[22] = "2016-05-01T10:00:00Z"
    a = ",".join(fields)
    fields[22], fields[9] = "2016-05-01T10:00:10+00:00", "30.0"
    b = ";".join(fields)
    p = os.path.join(scratch, "cars", "cars.gz")
    _gz(p, [a, b])
    ev = files.read_car_events(spark, p)
    got = sorted((str(r.ts), r.speed) for r in ev.collect())
    assert got == [("2016-05-01 10:00:00", 0.0), ("2016-05-01 10:00:10", 30.0)]

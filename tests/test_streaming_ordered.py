"""Ordered streams (reorder buffer, open segments, running positions and predictions, merged
partials): out of order within the delay, each equals its batch job."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cabline.operators import asof, rides as R, segments, traveltime
from cabline.sources import fixtures as fx
from cabline.streaming import jobs
from cabline.streaming.sources import parquet_stream
from tests.conftest import SF_SMALL
from tests.test_streaming import _rows, _run, _stream_dir

FAR = dt.datetime(2030, 1, 1)


def _disordered(spark, scratch, name, df, time_col, seconds, key_col, n=6, **far):
    """A stream of ``df`` whose rows arrive up to ``seconds`` late, ended by a far row of key -1."""
    jitter = F.pmod(F.xxhash64(*df.columns), F.lit(seconds))
    arriving = df.withColumn("emitted", F.col(time_col) + F.make_dt_interval(secs=jitter))
    end = df.limit(1).toPandas()
    for c, v in {key_col: -1, time_col: FAR, "emitted": FAR, **far}.items():
        end[c] = v
    path, schema = _stream_dir(spark, scratch, name, arriving, "emitted",
                               end[arriving.columns], n=n)
    assert not arriving.toPandas().sort_values("emitted")[time_col].is_monotonic_increasing
    return parquet_stream(spark, path, schema, 1)


def _hot(df, key):
    """A third of the rows on one key."""
    return df.withColumn(key, F.when(F.col(key) % 3 == 0, F.lit(3)).otherwise(F.col(key))
                         .cast(df.schema[key].dataType))


def _cars(spark):
    ce = fx.car_events(fx.load_events(spark, SF_SMALL))
    return _hot(ce.withColumn("ts", F.col("ts").cast("timestamp")), "car_id")


SEGMENT = ["car_id", "start_time", "length", "max_speed", "label"]


def test_stopped_segments_stream_equals_batch(spark, scratch):
    ce = _cars(spark)
    # every car ends with a stop: the batch job also returns segments that stay open
    last = ce.groupBy("car_id").agg(F.max("ts").alias("m")).join(ce, "car_id").where(
        "ts = m").dropDuplicates(["car_id"]).select(
        *[(F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias(c) if c == "ts" else
          F.lit(0.0).cast(ce.schema[c].dataType).alias(c) if c == "speed" else F.col(c)
          for c in ce.columns])
    ce = ce.unionByName(last)
    s = _disordered(spark, scratch, "stops", ce, "ts", 7200, "car_id")
    got = _run(jobs.stopped_segments(s, delay="2 hours", bucket_seconds=3600), "stop_stream",
               os.path.join(scratch, "ck"))
    want = _rows(segments.stopped_segments(ce), SEGMENT)
    assert len(want) > 50
    assert _rows(got, SEGMENT) == want


def test_stopped_segments_within_thirty_seconds(spark, scratch):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, i % 3, t0 + dt.timedelta(seconds=i // 2), 0.0 if i % 17 == 0 else float(i % 40),
             float(i % 9)) for i in range(600)]
    rows += [(1000 + k, k, t0 + dt.timedelta(seconds=400), 0.0, 0.0) for k in range(3)]
    ce = spark.createDataFrame(rows, "id long, car_id long, ts timestamp, speed double, throttle double")
    s = _disordered(spark, scratch, "secs", ce, "ts", 30, "car_id")
    got = _run(jobs.stopped_segments(s), "stop_secs", os.path.join(scratch, "ck"))
    assert _rows(got, SEGMENT) == _rows(segments.stopped_segments(ce), SEGMENT)


def test_gap_segments_of_a_hot_vehicle(spark, scratch):
    ce = _cars(spark)
    s = _disordered(spark, scratch, "gaps", ce, "ts", 7200, "car_id")
    out = jobs.gap_segments(s, gap="6 hours", delay="2 hours")
    got = [r for r in _rows(_run(out, "gap_hot", os.path.join(scratch, "ck")), SEGMENT) if r[0] != -1]
    assert got == _rows(segments.gap_segments(ce, gap_seconds=6 * 3600), SEGMENT)


def test_ride_order_stream_equals_batch(spark, scratch):
    r = R.with_event_time(fx.rides(fx.load_events(spark, SF_SMALL)))
    for c in ("start_time", "end_time", "event_time"):
        r = r.withColumn(c, F.col(c).cast("timestamp"))
    r = _hot(r, "driver_id")
    s = _disordered(spark, scratch, "rides", r, "event_time", 3600, "driver_id",
                    start_time=FAR, end_time=FAR)
    got = _run(jobs.ride_sequence(s, delay="1 hour", bucket_seconds=1800), "ride_order",
               os.path.join(scratch, "ck"))
    cols = ["driver_id", "ride_id", "is_start", "event_time", "seq"]
    assert _rows(got, cols) == _rows(R.ride_sequence(r), cols)


def test_running_predictions_stream_equals_batch(spark, scratch):
    samples = traveltime.travel_samples(fx.ride_pairs(fx.load_events(spark, SF_SMALL)))
    for c in ("start_time", "end_time"):
        samples = samples.withColumn(c, F.col(c).cast("timestamp"))
    s = _disordered(spark, scratch, "samples", samples, "end_time", 3600, "bucket")
    got = _run(jobs.running_predictions(s, delay="1 hour", bucket_seconds=1800), "predictions",
               os.path.join(scratch, "ck"))
    cols = ["bucket", "ride_id", "samples_before", "predicted"]
    assert _rows(got, cols) == _rows(traveltime.running_predictions(samples), cols)


def test_asof_stream_with_ties_null_keys_and_times(spark, scratch):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda s: t0 + dt.timedelta(seconds=s)                                    # noqa: E731
    trades = [(None if i % 11 == 0 else i % 3, at(i % 97), f"t{i}") for i in range(300)]
    customers = [(None if i % 13 == 0 else i % 3, at(i % 89), f"c{i:03d}") for i in range(200)]
    t = spark.createDataFrame(trades, "customer_id long, ts timestamp, trade_info string")
    c = spark.createDataFrame(customers, "customer_id long, ts timestamp, customer_info string")
    ts_ = _disordered(spark, scratch, "t", t, "ts", 20, "customer_id")
    cs = _disordered(spark, scratch, "c", c, "ts", 20, "customer_id")
    lone = spark.createDataFrame([(1, None, "lone")], t.schema)
    got = _run(jobs.trades_asof_customers(ts_, cs, delay="20 seconds"), "asof_ties",
               os.path.join(scratch, "ck"))
    cols = ["customer_id", "trade_ts", "trade_info", "customer_ts", "customer_info"]
    want = asof.asof_enrich(t, c).withColumnRenamed("ts", "trade_ts")
    found = sorted((tuple(r) for r in got.select(*cols).collect() if r[0] != -1), key=str)
    assert found == sorted((tuple(r) for r in want.select(*cols).collect()), key=str)
    assert asof.asof_enrich(lone, c).first().customer_info is None

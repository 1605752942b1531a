"""Parsing and printing of ride, fare and car-event lines."""

import pytest
from pyspark.sql import functions as F

from cabline.sources import codec


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_start_end_column_order(spark):
    df = codec.parse_rides(_lines(spark, [
        "1,START,2013-01-01 00:00:00,2013-01-01 00:10:00,-73.9,40.7,-73.8,40.8,1,10,20",
        "1,END,2013-01-01 00:10:00,2013-01-01 00:00:00,-73.9,40.7,-73.8,40.8,1,10,20"]))
    rows = df.orderBy(F.col("is_start").desc()).collect()
    for r in rows:
        assert str(r.start_time) == "2013-01-01 00:00:00"
        assert str(r.end_time) == "2013-01-01 00:10:00"
    assert [r.is_start for r in rows] == [True, False]


def test_empty_float_is_zero_and_bad_rows_quarantined(spark):
    good, bad = codec.parse_rides(_lines(spark, [
        "2,START,2013-01-01 00:00:00,2013-01-01 00:10:00,,,,,1,10,20",
        "3,MIDDLE,2013-01-01 00:00:00,2013-01-01 00:10:00,1,1,1,1,1,10,20",
        "4,START,2013-01-01 00:00:00,2013-01-01 00:10:00,1,1,1,1,1,10",
        "5,START,2013-01-01 00:00:00,2013-01-01 00:10:00,x,1,1,1,1,10,20",
        "6,START,2013-01-01 00:00:00,2013-01-01 00:10:00,1,1,1,1,1,10,20,,,"]), mode="quarantine")
    g = good.orderBy("ride_id").collect()
    assert [r.ride_id for r in g] == [2, 6]
    assert (g[0].start_lon, g[0].end_lat) == (0.0, 0.0)
    assert bad.count() == 3


def test_fail_mode_raises(spark):
    with pytest.raises(Exception, match="Invalid record"):
        codec.parse_rides(_lines(spark, ["1,START,bad"])).collect()


def test_fare_with_empty_last_field_is_rejected(spark):
    good, bad = codec.parse_fares(_lines(spark, [
        "1,10,20,2013-01-01 00:00:00,CSH,1.5,,12.0",
        "2,10,20,2013-01-01 00:00:00,CSH,1.5,0,"]), mode="quarantine")
    g = good.collect()
    assert [(r.ride_id, r.tolls) for r in g] == [(1, 0.0)]
    assert bad.count() == 1


def test_car_event_fields(spark):
    fields = [str(i) for i in range(23)]
    fields[0], fields[1] = "car-7", "ev-1"
    fields[9], fields[12], fields[20], fields[21] = "55.5", "12.5", "", "40.7"
    fields[22] = "2016-05-01T10:00:00+0100"
    line = ",".join(fields[:5]) + "; " + ",".join(fields[5:])
    r = codec.parse_car_events(_lines(spark, [line])).first()
    assert (r.car_id, r.id, r.speed, r.throttle, r.longitude, r.latitude) == \
        ("car-7", "ev-1", 55.5, 12.5, 0.0, pytest.approx(40.7))
    assert str(r.ts) == "2016-05-01 09:00:00"


def test_message_roundtrip(spark):
    src = codec.parse_rides(_lines(spark, [
        "7,START,2013-01-01 00:00:00,2013-01-01 00:10:00,-73.9,40.7,-73.8,40.8,1,10,20",
        "7,END,2013-01-01 00:10:00,2013-01-01 00:00:00,-73.9,40.7,-73.8,40.8,1,10,20"]))
    back = codec.decode_rides(codec.encode_rides(src))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.collect()))
    lines = sorted(r.value.decode() for r in codec.encode_rides(src).collect())
    assert lines[0].startswith("7,END,2013-01-01 00:10:00,2013-01-01 00:00:00,-73.9,40.7")


def test_nulls_keep_every_field_in_its_place(spark):
    import datetime as dt

    from cabline.sinks import render
    t = dt.datetime(2024, 1, 1)
    schema = ("ride_id long, is_start boolean, start_time timestamp, end_time timestamp, start_lon float, "
              "start_lat float, end_lon float, end_lat float, passenger_cnt short, taxi_id long, "
              "driver_id long")
    whole = (1, True, t, t, 1.5, 2.5, 3.5, 4.5, 1, 7, 8)
    rows = [whole] + [tuple(None if i == j else v for j, v in enumerate(whole)) for i in range(11)]
    rides = spark.createDataFrame(rows, schema)
    lines = [r.value for r in render.rides(rides).collect()]
    assert all(x.count(",") == 10 for x in lines)
    assert lines[1].startswith(",START,2024-01-01") and ",,2024" not in lines[1]
    good, bad = codec.parse_rides(render.rides(rides), mode="quarantine")
    # an empty coordinate reads as 0.0; any other empty field is a reject
    assert good.count() == 5 and bad.count() == 7
    messages, left = codec.encode_rides(rides, mode="quarantine")
    assert [tuple(r) for r in codec.decode_rides(messages).collect()] == [whole]
    assert left.count() == 11
    with pytest.raises(Exception, match="null field"):
        codec.encode_rides(rides).collect()
    fares = spark.createDataFrame([(1, None, 3, t, None, 1.0, None, 2.0)],
                                  "ride_id long, taxi_id long, driver_id long, start_time timestamp, "
                                  "payment_type string, tip float, tolls float, total_fare float")
    assert render.fares(fares).first().value == "1,,3,2024-01-01 00:00:00,,1.0,,2.0"

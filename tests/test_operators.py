"""Golden tests of the jobs on hand-made rows (FIXTURES.md §2-3)."""

import datetime as dt

from pyspark.sql import functions as F

from cabline.operators import asof, enrich, rides as R, segments, tips, traveltime


def _ts(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_asof_scripted_rows(spark):
    # customer and trade rows of the scripted sources (customerId 0, ms timestamps)
    custs = [(0, "Customer data @ 0"), (500, "Customer data @ 500"), (1500, "Customer data @ 1500"),
             (1600, "Customer data @ 1600"), (2100, "Customer data @ 2100")]
    trades = [(1000, "trade-1"), (1200, "trade-2"), (1500, "trade-3"), (1700, "trade-4"),
              (1800, "trade-5"), (2000, "trade-6")]
    c = spark.createDataFrame([(t, 0, i) for t, i in custs], "ms long, customer_id long, customer_info string") \
        .select(F.timestamp_millis("ms").alias("ts"), "customer_id", "customer_info")
    t = spark.createDataFrame([(ts, 0, i) for ts, i in trades], "ms long, customer_id long, trade_info string") \
        .select(F.timestamp_millis("ms").alias("ts"), "customer_id", "trade_info")
    for width in (1, 3600):
        got = {r.trade_info: r.customer_info for r in asof.asof_enrich(t, c, bucket_seconds=width).collect()}
        assert got == {"trade-1": "Customer data @ 500", "trade-2": "Customer data @ 500",
                       "trade-3": "Customer data @ 1500", "trade-4": "Customer data @ 1600",
                       "trade-5": "Customer data @ 1600", "trade-6": "Customer data @ 1600"}


def test_asof_no_earlier_customer_gives_null(spark):
    c = spark.createDataFrame([(5, 1, "late")], "s long, customer_id long, customer_info string") \
        .select(F.timestamp_seconds("s").alias("ts"), "customer_id", "customer_info")
    t = spark.createDataFrame([(1, 1, "t1"), (9, 2, "t2")], "s long, customer_id long, trade_info string") \
        .select(F.timestamp_seconds("s").alias("ts"), "customer_id", "trade_info")
    got = {r.trade_info: r.customer_info for r in asof.asof_enrich(t, c).collect()}
    assert got == {"t1": None, "t2": None}


CAR = "car_id long, s long, speed double, throttle double"


def _cars(spark, rows):
    return spark.createDataFrame(rows, CAR).select(
        "car_id", F.timestamp_seconds("s").alias("ts"), "speed", "throttle")


def test_gap_segments_boundary(spark):
    ev = _cars(spark, [(1, 0, 10.0, 1.0), (1, 15, 20.0, 3.0),      # exactly 15 s: together
                       (1, 31, 30.0, 5.0), (1, 40, 35.9, 5.0)])   # 16 s: new segment
    got = sorted((r.length, r.max_speed, round(r.erraticness, 6), r.label)
                 for r in segments.gap_segments(ev, gap_seconds=15).collect())
    assert got == [(2, 20, 1.0, "calm"), (2, 35, 0.0, "calm")]


def test_stopped_segments_rules(spark):
    ev = _cars(spark, [(1, 0, 0.0, 1.0),                           # stop first: empty segment
                       (1, 5, 10.0, 1.0), (1, 6, 30.0, 11.0),      # segment of 2
                       (1, 7, 0.0, 1.0), (1, 8, 0.0, 1.0),        # two stops in a row
                       (1, 9, 12.0, 2.0), (1, 9, 0.0, 2.0),       # other event at a stop's time
                       (1, 12, 50.0, 2.0),                         # after the last stop
                       (2, 1, 5.0, 1.0), (2, 2, 6.0, 1.0)])       # no stop at all
    for width in (1, 4, 86400):
        got = sorted((r.car_id, r.length, r.max_speed, round(r.erraticness, 6), r.label)
                     for r in segments.stopped_segments(ev, bucket_seconds=width).collect())
        assert got == [(1, 1, 50, 0.0, "calm"), (1, 2, 30, 5.0, "crazy"), (2, 2, 6, 0.0, "calm")]


def test_regression_with_zero_one_two_points(spark):
    rows = [(1, 0, 2.0, 10.0), (2, 1, 1.0, 3.0), (3, 1, 2.0, 8.0)]
    s = spark.createDataFrame(rows, "ride_id long, bucket int, distance double, travel_minutes double")
    m = {r.bucket: (r.n, r.slope) for r in traveltime.fit_model(s).collect()}
    assert m[0] == (1, None)                       # one point: no slope
    assert abs(m[1][1] - (1 * 3 + 2 * 8) / (1 + 4)) < 1e-12
    pred = traveltime.predict(traveltime.fit_model(s), s.where("bucket = 0").union(
        spark.createDataFrame([(9, 5, 1.0, 0.0)], s.schema)))
    assert sorted(r.predicted for r in pred.collect()) == [-1, -1]   # 1 point / empty bucket


def test_running_prediction_uses_earlier_rows_only(spark):
    rows = [(i, 3, float(i), float(2 * i), i * 60) for i in range(1, 6)]
    s = spark.createDataFrame(rows, "ride_id long, bucket int, distance double, "
                                    "travel_minutes double, s long") \
        .withColumn("end_time", F.timestamp_seconds("s"))
    for width in (60, 86400):
        got = {r.ride_id: (r.samples_before, r.predicted)
               for r in traveltime.running_predictions(s, bucket_seconds=width).collect()}
        assert got == {1: (0, -1), 2: (1, -1), 3: (2, 6), 4: (3, 8), 5: (4, 10)}


def test_hourly_tips_ties_edges_and_totals(spark):
    rows = [(1, 7, "2024-01-01 00:10:00", "2.00"), (2, 8, "2024-01-01 00:20:00", "2.00"),
            (3, 9, "2024-01-01 01:00:00", "1.00")]   # exactly on the hour: next window
    f = spark.createDataFrame(rows, "ride_id long, driver_id long, t string, tip string").select(
        "ride_id", "driver_id", F.col("t").cast("timestamp").alias("start_time"),
        F.col("tip").cast("decimal(18,2)").alias("tip"))
    t = tips.hourly_tips(f)
    best = {r.window_end: (r.driver_id, r.tips)
            for r in tips.label_with_window_end(tips.hourly_max(t)).collect()}
    assert best == {"2024-01-01T01:00:00Z": (7, 4.0 / 2), "2024-01-01T02:00:00Z": (9, 1.0)}
    total = t.agg(F.sum("tips")).first()[0]
    assert float(total) == 5.0
    line = tips.render_tuple(tips.label_with_window_end(t)).orderBy("value").first().value
    assert line == "(2024-01-01T01:00:00Z,7,2.0)"


RIDE = ("ride_id long, is_start boolean, start_time timestamp, end_time timestamp, "
        "start_lon float, start_lat float, end_lon float, end_lat float, passenger_cnt short, "
        "taxi_id long, driver_id long")
FARE = ("ride_id long, taxi_id long, driver_id long, start_time timestamp, payment_type string, "
        "tip float, tolls float, total_fare float")


def _pairs_fixture(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    s = lambda k: t0 + dt.timedelta(seconds=k)
    rides = [(1, True, s(0), s(60), -73.9, 40.7, -73.8, 40.7, 1, 1, 1),   # fare equal time
             (2, True, s(5), s(65), -73.9, 40.7, -73.8, 40.7, 1, 1, 1),   # fare 5 s later
             (3, True, s(9), s(70), -73.9, 40.7, -73.8, 40.7, 1, 1, 1),   # no fare
             (1000, True, s(3), s(80), -73.9, 40.7, -73.8, 40.7, 1, 1, 1),  # dropped: id % 1000
             (1, False, s(0), s(60), -73.9, 40.7, -73.8, 40.7, 1, 1, 1)]
    fares = [(1, 1, 1, s(0), "CSH", 1.0, 0.0, 5.0), (2, 1, 1, s(10), "CSH", 2.0, 0.0, 5.0),
             (4, 1, 1, s(11), "CSH", 3.0, 0.0, 5.0), (1000, 1, 1, s(3), "CSH", 4.0, 0.0, 5.0)]
    return spark.createDataFrame(rides, RIDE), spark.createDataFrame(fares, FARE)


def test_rides_with_fares(spark):
    r, f = _pairs_fixture(spark)
    got = sorted((x.ride_id, x.tip) for x in enrich.rides_with_fares(r, f).collect())
    assert got == [(1, 1.0), (2, 2.0), (1000, 4.0)]


def test_expiring_outcomes_partition_the_inputs(spark):
    r, f = _pairs_fixture(spark)
    started = R.start_events_with_loss(r, 1000)
    pairs = enrich.match_with_expiry(started, f, max_wait_seconds=0)
    got = sorted((x.key_ride_id, x.outcome) for x in pairs.collect())
    assert got == [(1, "matched"), (2, "unmatched_fare"), (2, "unmatched_ride"),
                   (3, "unmatched_ride"), (4, "unmatched_fare"), (1000, "unmatched_fare")]
    assert enrich.matched(pairs).count() + enrich.unmatched_rides(pairs).count() == started.count()
    assert enrich.matched(pairs).count() + enrich.unmatched_fares(pairs).count() == f.count()
    wide = enrich.match_with_expiry(started, f, max_wait_seconds=5)
    assert sorted(x.key_ride_id for x in enrich.matched(wide).collect()) == [1, 2]


def test_dedupe_latest_keeps_one_ride(spark):
    r, f = _pairs_fixture(spark)
    dup = r.union(r.where("ride_id = 1 AND is_start").withColumn("driver_id", F.lit(99)))
    got = enrich.rides_with_fares(dup, f, dedupe="latest").where("ride_id = 1").count()
    assert got == 1


def test_null_vehicle_is_one_vehicle(spark):
    """Rows with a null vehicle id are one vehicle, as in a plain window: nothing is dropped."""
    trace = [(0, 10.0, 1.0), (15, 20.0, 3.0), (31, 0.0, 5.0), (40, 35.9, 5.0)]
    ev = _cars(spark, [(c, s, v, t) for c in (1, None) for s, v, t in trace])
    for job in (lambda e: segments.gap_segments(e, gap_seconds=15), segments.stopped_segments):
        got = {}
        for r in job(ev).collect():
            got.setdefault(r.car_id, []).append((r.length, r.max_speed, r.label))
        assert set(got) == {1, None}
        assert sorted(got[None]) == sorted(got[1])


def test_rows_without_an_id_are_kept_unmatched(spark):
    r, f = _pairs_fixture(spark)
    started = R.start_events_with_loss(r, 1000)
    r2 = started.unionByName(started.limit(2).withColumn("ride_id", F.lit(None).cast("long")))
    f2 = f.unionByName(f.limit(1).withColumn("ride_id", F.lit(None).cast("long")))
    pairs = enrich.match_with_expiry(r2, f2, max_wait_seconds=0)
    assert enrich.matched(pairs).count() + enrich.unmatched_rides(pairs).count() == r2.count()
    assert enrich.matched(pairs).count() + enrich.unmatched_fares(pairs).count() == f2.count()
    assert enrich.unmatched_rides(pairs).where("ride_id IS NULL").count() == 2
    assert enrich.unmatched_fares(pairs).where("ride_id IS NULL").count() == 1
    # the inner pairing never pairs a missing id
    assert enrich.rides_with_fares(r2, f2).where("ride_id IS NULL").count() == 0


def test_asof_equals_duckdb_asof_join_with_nulls(spark):
    """Random trades and customers (hot key, null keys and times) against DuckDB's ASOF JOIN."""
    import random

    import duckdb
    import pandas as pd
    rnd = random.Random(5)
    key = lambda: rnd.choice([0, 0, 0, 1, 2, None])              # noqa: E731
    sec = lambda: rnd.choice([None] + list(range(0, 4000, 7)))   # noqa: E731, unique-ish times
    custs = pd.DataFrame([(key(), sec(), f"c{i}") for i in range(150)],
                         columns=["customer_id", "s", "customer_info"])
    custs = custs.drop_duplicates(["customer_id", "s"])            # one record per key and time
    trades = pd.DataFrame([(key(), sec(), f"t{i}") for i in range(200)],
                          columns=["customer_id", "s", "trade_info"])
    to_ts = lambda df: df.assign(ts=pd.to_datetime(df["s"], unit="s")).drop(columns="s")
    c_pd, t_pd = to_ts(custs), to_ts(trades)
    c = spark.createDataFrame(c_pd.astype(object).where(c_pd.notna(), None),
                              "customer_id long, customer_info string, ts timestamp")
    t = spark.createDataFrame(t_pd.astype(object).where(t_pd.notna(), None),
                              "customer_id long, trade_info string, ts timestamp")
    got = sorted((r.trade_info, r.customer_info) for r in asof.asof_enrich(t, c).collect())
    con = duckdb.connect()
    con.register("c", c_pd)
    con.register("t", t_pd)
    want = sorted(con.execute(
        "SELECT t.trade_info, c.customer_info FROM t ASOF LEFT JOIN c "
        "ON t.customer_id = c.customer_id AND t.ts >= c.ts").fetchall())
    assert got == want


def test_segments_equal_duckdb_windows_with_nulls(spark):
    """Random traces (null vehicle ids and speeds, tied times) against the SQL definitions."""
    import random

    import duckdb
    import pandas as pd
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        car = rnd.choice([1, 1, 2, 3, None])
        rows.append((car, i, rnd.choice(range(0, 3000, 3)),
                     rnd.choice([0.0, 0.0, 5.0, 12.5, 40.0, None]), float(rnd.randint(0, 9))))
    pdf = pd.DataFrame(rows, columns=["car_id", "id", "s", "speed", "throttle"])
    pdf["ts"] = pd.to_datetime(pdf["s"], unit="s")
    ev = spark.createDataFrame(pdf.drop(columns="s").astype(object).where(pdf.drop(columns="s").notna(), None),
                               "car_id long, id long, speed double, throttle double, ts timestamp")
    con = duckdb.connect()
    con.register("ev", pdf)
    stats = ("count(*) AS length, CAST(trunc(max(speed)) AS INTEGER) AS max_speed, "
             "round(stddev_pop(throttle), 6) AS e")
    stopped_sql = f"""
      WITH s AS (SELECT *, sum(CASE WHEN speed = 0.0 THEN 1 ELSE 0 END) OVER (PARTITION BY car_id
                    ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg,
                  max(CASE WHEN speed = 0.0 THEN 1 ELSE 0 END) OVER (PARTITION BY car_id, ts) AS st
                 FROM ev)
      SELECT car_id, {stats} FROM s WHERE st = 0 GROUP BY car_id, seg"""
    gap_sql = f"""
      WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL
                   OR epoch(ts) - epoch(lag(ts) OVER w) > 60 THEN 1 ELSE 0 END AS st
                 FROM ev WINDOW w AS (PARTITION BY car_id ORDER BY ts)),
           s AS (SELECT *, sum(st) OVER (PARTITION BY car_id ORDER BY ts
                   ROWS UNBOUNDED PRECEDING) AS seg FROM g)
      SELECT car_id, {stats} FROM s GROUP BY car_id, seg"""

    def spark_rows(df):
        return sorted((-1 if r.car_id is None else r.car_id, r.length,
                       -999 if r.max_speed is None else r.max_speed, round(r.erraticness, 6))
                      for r in df.collect())

    def duck_rows(sql):
        return sorted((-1 if pd.isna(c) else int(c), n, -999 if pd.isna(m) else int(m), e)
                      for c, n, m, e in con.execute(sql).fetchall())

    assert spark_rows(segments.stopped_segments(ev)) == duck_rows(stopped_sql)
    assert spark_rows(segments.gap_segments(ev, gap_seconds=60)) == duck_rows(gap_sql)


def test_expiring_join_equals_duckdb_with_wait_duplicates_and_nulls(spark):
    """Random START rides and fares (duplicated ids keep their latest row, missing ids,
    times a few seconds apart) against the SQL definition with a 5 s wait."""
    import datetime as dt
    import random

    import duckdb
    import pandas as pd
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    rides, fares = [], []
    for i in range(400):
        rid = rnd.choice(list(range(60)) + [None])
        rides.append((rid, True, t0 + dt.timedelta(seconds=rnd.randint(0, 40) * 3 + i % 3),
                      t0, -73.9, 40.7, -73.8, 40.7, 1, 1, i))        # driver_id = row number
    for i in range(300):
        rid = rnd.choice(list(range(70)) + [None])
        fares.append((rid, 1, i, t0 + dt.timedelta(seconds=rnd.randint(0, 40) * 3 + i % 3),
                      "CSH", float(i), 0.0, 1.0))
    r, f = spark.createDataFrame(rides, RIDE), spark.createDataFrame(fares, FARE)
    got = enrich.match_with_expiry(r, f, max_wait_seconds=5)
    got = sorted((x.outcome, x.driver_id if x.outcome != "unmatched_fare" else None,
                  x.fare_driver_id) for x in got.collect())
    con = duckdb.connect()
    con.register("r", pd.DataFrame([(x[0], x[2], x[10]) for x in rides], columns=["id", "t", "drv"]))
    con.register("f", pd.DataFrame([(x[0], x[3], x[2]) for x in fares], columns=["id", "t", "drv"]))
    want = con.execute("""
      WITH lr AS (SELECT * FROM r WHERE id IS NULL UNION ALL SELECT * FROM r WHERE id IS NOT NULL
                  QUALIFY row_number() OVER (PARTITION BY id ORDER BY t DESC, drv DESC) = 1),
           lf AS (SELECT * FROM f WHERE id IS NULL UNION ALL SELECT * FROM f WHERE id IS NOT NULL
                  QUALIFY row_number() OVER (PARTITION BY id ORDER BY t DESC, drv DESC) = 1)
      SELECT CASE WHEN lr.drv IS NOT NULL AND lf.drv IS NOT NULL THEN 'matched'
                  WHEN lr.drv IS NOT NULL THEN 'unmatched_ride' ELSE 'unmatched_fare' END,
             lr.drv, lf.drv
      FROM lr FULL JOIN lf ON lr.id = lf.id AND abs(epoch(lr.t) - epoch(lf.t)) <= 5""").fetchall()
    norm = lambda v: None if v is None or pd.isna(v) else int(v)
    want = sorted((o, norm(a), norm(b)) for o, a, b in want)
    assert got == want
    assert {o for o, _, _ in got} == {"matched", "unmatched_ride", "unmatched_fare"}


def test_ride_order_start_before_end_on_ties(spark):
    """W1: rides in event-time order; at equal times START comes before END, then by id."""
    import datetime as dt
    t = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=k)
    rows = [(5, False, t(0), t(10), -73.9, 40.7, -73.8, 40.7, 1, 1, 1),    # END at 10
            (7, True, t(10), t(20), -73.9, 40.7, -73.8, 40.7, 1, 1, 1),    # START at 10
            (6, True, t(10), t(30), -73.9, 40.7, -73.8, 40.7, 1, 1, 1),    # START at 10
            (8, True, t(2), t(12), -73.9, 40.7, -73.8, 40.7, 1, 1, 1)]     # START at 2
    r = spark.createDataFrame(rows, RIDE)
    got = [(x.ride_id, x.is_start) for x in R.sort_rides(r).collect()]
    assert got == [(8, True), (6, True), (7, True), (5, False)]
    seq = {(x.ride_id, x.is_start): x.seq for x in R.ride_sequence(r, bucket_seconds=5).collect()}
    assert seq == {(8, True): 1, (6, True): 2, (7, True): 3, (5, False): 4}


def test_distance_to_point_uses_the_ride_end_of_its_kind(spark):
    """G8: START rides measure from their start point, END rides from their end point."""
    from cabline.functions import geo
    r = spark.createDataFrame([(True, -73.9, 40.7, -73.8, 40.8), (False, -73.9, 40.7, -73.8, 40.8)],
                              "is_start boolean, slon float, slat float, elon float, elat float")
    p = F.lit(-73.85).cast("float"), F.lit(40.75).cast("float")
    got = r.select(geo.distance_to_point("is_start", "slon", "slat", "elon", "elat", *p).alias("d"),
                   geo.distance(*p, "slon", "slat").alias("to_start"),
                   geo.distance(*p, "elon", "elat").alias("to_end")).collect()
    assert got[0].d == got[0].to_start and got[1].d == got[1].to_end
    assert got[0].d != got[1].d


def test_rows_without_id_or_time(spark):
    """A ride without an id is not lost and comes out unmatched; events without a time belong
    to no segment."""
    t = dt.datetime(2024, 1, 1)
    cols = ("ride_id long, is_start boolean, start_time timestamp, end_time timestamp, start_lon float, "
            "start_lat float, end_lon float, end_lat float, passenger_cnt short, taxi_id long, driver_id long")
    r = spark.createDataFrame([(None, True, t, t, -73.9, 40.7, -73.9, 40.7, 1, 1, 1),
                               (1000, True, t, t, -73.9, 40.7, -73.9, 40.7, 1, 1, 1),
                               (1, True, t, t, -73.9, 40.7, -73.9, 40.7, 1, 1, 1),
                               (2, False, t, t, -73.9, 40.7, -73.9, 40.7, 1, 1, 1)], cols)
    f = spark.createDataFrame([(1, 1, 1, t, "CSH", 1.0, 0.0, 2.0)],
                              "ride_id long, taxi_id long, driver_id long, start_time timestamp, "
                              "payment_type string, tip float, tolls float, total_fare float")
    started = R.start_events_with_loss(r, 1000)
    assert sorted(str(x.ride_id) for x in started.collect()) == ["1", "None"]
    pairs = enrich.match_with_expiry(started, f)
    assert [x.ride_id for x in enrich.unmatched_rides(pairs).collect()] == [None]
    events = spark.createDataFrame(
        [(1, t, 5.0, 1.0), (1, t + dt.timedelta(seconds=5), 6.0, 3.0), (1, None, 50.0, 90.0),
         (1, None, 0.0, 0.0)], "car_id long, ts timestamp, speed double, throttle double")
    for out in (segments.gap_segments(events), segments.stopped_segments(events)):
        (one,) = out.collect()
        assert (one.start_time, one.length, one.max_speed, one.erraticness) == (t, 2, 6, 1.0)

"""DuckDB SQL for every driver query (the correctness oracle).

The views of FIXTURES.md §4 are rebuilt here as CTEs over ``events``, written
independently of the Spark code: joins instead of aggregates, ``lag`` and
running sums instead of bucketed scans, ``ASOF JOIN`` instead of a carried
last value, a recursive CTE for the path walk.  All literals are doubles.
"""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format


def _lon(e):
    return f"CAST({D(-74.10)} + CAST({e} % 500 AS DOUBLE) * {D(0.001)} AS FLOAT)"


def _lat(u):
    return f"CAST({D(40.45)} + CAST({u} % 150 AS DOUBLE) * {D(0.004)} AS FLOAT)"


def _in_nyc(lon, lat):
    return (f"(NOT ({lon} > {D(-73.7)} OR {lon} < {D(-74.05)}) "
            f"AND NOT ({lat} > {D(41.0)} OR {lat} < {D(40.5)}))")


def _cell(lon, lat):
    return (f"CAST(floor(({D(74.05)} - abs({lon})) / {D(0.0014)}) "
            f"+ 250 * floor(({D(41.0)} - {lat}) / {D(0.00125)}) AS INTEGER)")


RIDE_PAIRS = f"""ride_pairs AS (
  SELECT s.event_id // 2 AS ride_id, s.ts AS start_time, o.ts AS end_time,
         {_lon('s.event_id')} AS start_lon, {_lat('s.user_id')} AS start_lat,
         CASE WHEN o.ts IS NOT NULL THEN {_lon('o.event_id')} END AS end_lon,
         CASE WHEN o.ts IS NOT NULL THEN {_lat('o.user_id')} END AS end_lat,
         CAST(1 AS SMALLINT) AS passenger_cnt, s.user_id AS taxi_id, s.user_id AS driver_id
  FROM events s LEFT JOIN events o ON o.event_id = s.event_id + 1
  WHERE s.event_id % 2 = 0)"""

RIDES = """rides AS (
  SELECT ride_id, TRUE AS is_start, start_time, end_time, start_lon, start_lat, end_lon, end_lat,
         passenger_cnt, taxi_id, driver_id FROM ride_pairs
  UNION ALL
  SELECT ride_id, FALSE AS is_start, start_time, end_time, start_lon, start_lat, end_lon, end_lat,
         passenger_cnt, taxi_id, driver_id FROM ride_pairs WHERE end_time IS NOT NULL)"""

FARES_FOR_RIDES = """fares_for_rides AS (
  SELECT event_id // 2 AS ride_id, user_id AS taxi_id, user_id AS driver_id,
         ts + CASE WHEN (event_id // 2) % 11 = 0 THEN INTERVAL 5 SECOND ELSE INTERVAL 0 SECOND END
           AS start_time,
         event_type AS payment_type, CAST(value AS FLOAT) AS tip, CAST(0.0 AS FLOAT) AS tolls,
         CAST(value AS FLOAT) AS total_fare
  FROM events WHERE event_id % 2 = 0 AND (event_id // 2) % 7 <> 0)"""

ALL_FARES = FARES_FOR_RIDES.replace(" AND (event_id // 2) % 7 <> 0", "")

FARES_BY_DRIVER = """fares_by_driver AS (
  SELECT event_id AS ride_id, user_id AS driver_id, ts AS start_time,
         CAST(value AS DECIMAL(18,2)) AS tip FROM events)"""

CAR_EVENTS = f"""car_events AS (
  SELECT user_id AS car_id, event_id AS id, ts,
         CASE WHEN event_type = 'error' THEN {D(0.0)} ELSE value END AS speed,
         value AS throttle FROM events)"""

SAMPLES = f"""samples AS (
  SELECT ride_id, start_time, end_time, distance, direction,
         CAST(trunc(direction / {D(45)}) AS INTEGER) AS bucket,
         (epoch_us(end_time) - epoch_us(start_time)) / {D(60000000.0)} AS travel_minutes
  FROM (SELECT ride_id, start_time, end_time,
               {D(110.25)} * sqrt(dx * dx + dy * dy) AS distance,
               CAST(trunc(degrees(atan2(ex, ey))) AS INTEGER) + 179 AS direction
        FROM (SELECT ride_id, start_time, end_time,
                     CAST(start_lat - end_lat AS DOUBLE) AS dx,
                     CAST(start_lon - end_lon AS DOUBLE) * cos(CAST(end_lat AS DOUBLE)) AS dy,
                     CAST(end_lat - start_lat AS DOUBLE) AS ex,
                     CAST(end_lon - start_lon AS DOUBLE) * cos(CAST(start_lat AS DOUBLE)) AS ey
              FROM ride_pairs WHERE end_time IS NOT NULL) a) b)"""

HOURLY = """hourly AS (
  SELECT strftime(date_trunc('hour', start_time) + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ')
           AS window_end, driver_id, SUM(tip) AS tips_dec
  FROM fares_by_driver GROUP BY 1, 2)"""

EXPIRING = """exp AS (
  SELECT r.ride_id AS r_id, r.driver_id AS r_driver, r.ride_time, r.start_lon AS r_lon,
         r.start_lat AS r_lat, f.ride_id AS f_id, f.driver_id AS f_driver,
         f.start_time AS f_time, f.payment_type, f.tip, f.total_fare
  FROM (SELECT *, start_time AS ride_time FROM rides
        WHERE is_start AND ride_id % 1000 <> 0) r
  FULL JOIN fares_for_rides f
    ON r.ride_id = f.ride_id AND r.ride_time >= f.start_time - INTERVAL 0 SECOND
       AND r.ride_time <= f.start_time + INTERVAL 0 SECOND)"""


def _with(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


def _segment_select(group):
    e = "round(stddev_pop(throttle), 6)"
    label = (f"CASE CAST(trunc({e} / {D(2.5)}) AS INTEGER) WHEN 0 THEN 'calm' "
             f"WHEN 1 THEN 'busy' ELSE 'crazy' END")
    return (f"SELECT car_id, min(ts) AS start_time, count(*) AS length, "
            f"CAST(trunc(max(speed)) AS INTEGER) AS max_speed, {e} AS erraticness, "
            f"{label} AS label FROM {group}")


_EVT = "CASE WHEN is_start THEN start_time ELSE end_time END"
MIN_SUM_XX = "4.9406564584124654e-323"


def _walk_step():
    """Next (x, y) of the path walk, written out as the literal step rule."""
    up_y = f"((cx - sx + {D(0.5)}) * slope + sy - {D(0.5)})"
    dn_y = f"((cx - sx + {D(0.5)}) * slope + sy + {D(0.5)})"
    up_diag = f"({up_y} > cy - {D(0.05)} AND {up_y} < cy + {D(0.05)})"
    dn_diag = f"({dn_y} > cy - {D(0.05)} AND {dn_y} < cy + {D(0.05)})"
    mx = f"(CASE WHEN {dn_diag} THEN cx + 1 ELSE cx END)"
    my = f"(CASE WHEN {dn_diag} THEN cy - 1 ELSE cy END)"
    nx = (f"CASE WHEN slope > 0 THEN (CASE WHEN {up_diag} OR {up_y} < cy THEN cx + 1 ELSE cx END) "
          f"ELSE (CASE WHEN {dn_y} > {my} THEN {mx} + 1 ELSE {mx} END) END")
    ny = (f"CASE WHEN slope > 0 THEN (CASE WHEN {up_diag} OR NOT ({up_y} < cy) THEN cy + 1 "
          f"ELSE cy END) "
          f"ELSE (CASE WHEN {dn_y} > {my} THEN {my} ELSE {my} - 1 END) END")
    return nx, ny


def _walk_sql(columns, paths, last):
    """The walk over ``paths``: end points per row and ``columns`` that are carried along."""
    nx, ny = _walk_step()
    return ("WITH RECURSIVE " + RIDE_PAIRS + ",\n" + f"""{paths},
norm AS (
  SELECT CASE WHEN x1 <= x2 THEN x1 ELSE x2 END AS sx, CASE WHEN x1 <= x2 THEN y1 ELSE y2 END AS sy,
         CASE WHEN x1 <= x2 THEN x2 ELSE x1 END AS ex, CASE WHEN x1 <= x2 THEN y2 ELSE y1 END AS ey,
         {columns} FROM paths),
walk(sx, sy, ex, ey, slope, {columns}, cx, cy) AS (
  SELECT sx, sy, ex, ey, CAST(ey - sy AS DOUBLE) / (CAST(ex - sx AS DOUBLE) + {D(0.00000001)}),
         {columns}, sx, sy FROM norm
  UNION ALL
  SELECT sx, sy, ex, ey, slope, {columns}, {nx}, {ny} FROM walk
  WHERE (cx < ex OR cy <> ey) AND NOT (slope > 0 AND cy > ey) AND NOT (slope <= 0 AND cy < ey))
{last}""")


def _ends():
    xs = f"CAST(floor(({D(74.05)} - abs({{}})) / {D(0.0014)}) AS BIGINT)"
    ys = f"CAST(floor(({D(41.0)} - {{}}) / {D(0.00125)}) AS BIGINT)"
    return f"""SELECT ride_id, {xs.format('start_lon')} AS x1, {ys.format('start_lat')} AS y1,
           {xs.format('end_lon')} AS x2, {ys.format('end_lat')} AS y2
    FROM ride_pairs WHERE end_time IS NOT NULL
      AND {_in_nyc('start_lon', 'start_lat')} AND {_in_nyc('end_lon', 'end_lat')}"""


def _cell_traffic_sql():
    paths = f"""paths AS (
  SELECT x1, y1, x2, y2, count(*) AS weight FROM ({_ends()}) p
  GROUP BY x1, y1, x2, y2)"""
    return _walk_sql("weight", paths, "SELECT CAST(cx + cy * 250 AS INTEGER) AS cell_id, "
                     "CAST(sum(weight) AS BIGINT) AS rides FROM walk GROUP BY 1")


def _ride_cells_sql():
    return _walk_sql("ride_id", f"paths AS ({_ends()})",
                     "SELECT ride_id, CAST(cx + cy * 250 AS INTEGER) AS cell_id FROM walk")


def oracle_sql() -> dict[str, str]:
    base = _with(RIDE_PAIRS, RIDES)
    q = {}
    q["ride_cleansing"] = base + (
        f"SELECT * FROM rides WHERE {_in_nyc('start_lon', 'start_lat')} "
        f"AND {_in_nyc('end_lon', 'end_lat')}")
    q["ride_event_order"] = base + (
        f"SELECT ride_id, is_start, driver_id, {_EVT} AS event_time, "
        f"row_number() OVER (PARTITION BY driver_id ORDER BY {_EVT}, "
        f"CASE WHEN is_start THEN 0 ELSE 1 END, ride_id) AS seq FROM rides")
    q["hourly_tips"] = _with(FARES_BY_DRIVER, HOURLY) + (
        "SELECT window_end, driver_id, CAST(tips_dec AS DOUBLE) AS tips FROM hourly")
    q["hourly_max_tips"] = _with(FARES_BY_DRIVER, HOURLY) + (
        "SELECT window_end, driver_id, CAST(tips_dec AS DOUBLE) AS tips FROM hourly "
        "QUALIFY row_number() OVER (PARTITION BY window_end ORDER BY tips_dec DESC, driver_id) = 1")
    q["rides_with_fares"] = _with(RIDE_PAIRS, RIDES, ALL_FARES) + (
        "SELECT r.ride_id, r.is_start, r.start_time, r.end_time, r.start_lon, r.start_lat, "
        "r.end_lon, r.end_lat, r.passenger_cnt, r.taxi_id, r.driver_id, "
        "f.start_time AS fare_start_time, f.payment_type, f.tip, f.tolls, f.total_fare "
        "FROM rides r JOIN fares_for_rides f ON r.ride_id = f.ride_id WHERE r.is_start")
    exp = _with(RIDE_PAIRS, RIDES, FARES_FOR_RIDES, EXPIRING)
    q["expiring_matched"] = exp + (
        "SELECT r_id AS ride_id, r_driver AS driver_id, ride_time, f_time AS fare_start_time, "
        "payment_type, tip, total_fare FROM exp WHERE r_id IS NOT NULL AND f_id IS NOT NULL")
    q["unmatched_rides"] = exp + (
        "SELECT r_id AS ride_id, r_driver AS driver_id, ride_time, r_lon AS start_lon, "
        "r_lat AS start_lat FROM exp WHERE f_id IS NULL")
    q["unmatched_fares"] = exp + (
        "SELECT f_id AS ride_id, f_driver AS driver_id, f_time AS start_time, tip "
        "FROM exp WHERE r_id IS NULL")
    q["trades_asof_customers"] = (
        "WITH customers AS (SELECT ts, user_id AS customer_id, CAST(event_id AS VARCHAR) "
        "AS customer_info FROM events WHERE event_type = 'view'),\n"
        "trades AS (SELECT ts, user_id AS customer_id, CAST(event_id AS VARCHAR) AS trade_info "
        "FROM events WHERE event_type = 'purchase')\n"
        "SELECT t.customer_id, t.ts AS trade_ts, t.trade_info, c.ts AS customer_ts, "
        "c.customer_info FROM trades t ASOF LEFT JOIN customers c "
        "ON t.customer_id = c.customer_id AND t.ts >= c.ts")
    q["gap_segments"] = _with(CAR_EVENTS, """g AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL
                   OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 21600000000 THEN 1 ELSE 0 END AS st
  FROM car_events WINDOW w AS (PARTITION BY car_id ORDER BY ts))""", """s AS (
  SELECT *, sum(st) OVER (PARTITION BY car_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS seg
  FROM g)""") + _segment_select("s GROUP BY car_id, seg")
    q["stopped_segments"] = _with(CAR_EVENTS, f"""s AS (
  SELECT *, sum(CASE WHEN speed = {D(0.0)} THEN 1 ELSE 0 END) OVER (PARTITION BY car_id ORDER BY ts
              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg,
         max(CASE WHEN speed = {D(0.0)} THEN 1 ELSE 0 END) OVER (PARTITION BY car_id, ts)
           AS stop_at_ts
  FROM car_events)""") + _segment_select("s WHERE stop_at_ts = 0 GROUP BY car_id, seg")
    q["rides_per_cell"] = base + (
        f"""SELECT cell_id, hour, CAST(sum(CASE WHEN is_start THEN 1 ELSE 0 END) AS BIGINT) AS starts,
       CAST(sum(CASE WHEN is_start THEN 0 ELSE 1 END) AS BIGINT) AS ends,
       CAST(-({D(74.05)} - (cell_id % 250) * {D(0.0014)} - {D(0.0007)}) AS FLOAT) AS center_lon,
       CAST({D(41.0)} - ((cell_id - cell_id % 250) // 250) * {D(0.00125)} - {D(0.000625)} AS FLOAT)
         AS center_lat
FROM (SELECT {_cell('lon', 'lat')} AS cell_id, date_trunc('hour', t) AS hour, is_start
      FROM (SELECT CASE WHEN is_start THEN start_lon ELSE end_lon END AS lon,
                   CASE WHEN is_start THEN start_lat ELSE end_lat END AS lat,
                   is_start, {_EVT} AS t FROM rides) p
      WHERE {_in_nyc('lon', 'lat')}) c
GROUP BY cell_id, hour""")
    q["cell_traffic"] = _cell_traffic_sql()
    q["ride_distance_direction"] = _with(RIDE_PAIRS, SAMPLES) + (
        "SELECT ride_id, round(distance, 6) AS distance, direction FROM samples")
    q["travel_time_model"] = _with(RIDE_PAIRS, SAMPLES) + (
        f"SELECT bucket, count(*) AS n, round(CASE WHEN count(*) >= 2 AND "
        f"sum(distance * distance) >= {MIN_SUM_XX} THEN sum(distance * travel_minutes) / "
        f"sum(distance * distance) END, 6) AS slope FROM samples GROUP BY bucket")
    q["travel_time_predictions"] = _with(RIDE_PAIRS, SAMPLES) + (
        f"""SELECT ride_id, bucket, count(*) OVER w AS samples_before,
       COALESCE(CAST(trunc(CASE WHEN count(*) OVER w >= 2
                                 AND sum(distance * distance) OVER w >= {MIN_SUM_XX}
                            THEN sum(distance * travel_minutes) OVER w
                                 / sum(distance * distance) OVER w END * distance) AS INTEGER), -1)
         AS predicted
FROM samples
WINDOW w AS (PARTITION BY bucket ORDER BY end_time, ride_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
    q["measurement_points"] = (
        "SELECT epoch_us(ts) // 1000 AS ts_ms, event_type AS key, value, "
        "'events' || ',key=' || replace(replace(replace(event_type, ',', '\\,'), '=', '\\='), "
        "' ', '\\ ') || ' value=' || CAST(value AS VARCHAR) || ' ' "
        "|| CAST(epoch_us(ts) // 1000 AS VARCHAR) "
        "AS line FROM events")
    q["ride_messages_roundtrip"] = base + (
        "SELECT ride_id, is_start, date_trunc('second', start_time) AS start_time, "
        "date_trunc('second', end_time) AS end_time, start_lon, start_lat, end_lon, end_lat, "
        "passenger_cnt, taxi_id, driver_id FROM rides")
    q["sql_functions"] = _with(RIDE_PAIRS) + (
        f"SELECT ride_id, in_nyc, cell_id, "
        f"CAST(-({D(74.05)} - (cell_id % 250) * {D(0.0014)} - {D(0.0007)}) AS FLOAT) AS lon, "
        f"CAST({D(41.0)} - ((cell_id - cell_id % 250) // 250) * {D(0.00125)} - {D(0.000625)} "
        f"AS FLOAT) AS lat FROM (SELECT ride_id, {_in_nyc('start_lon', 'start_lat')} AS in_nyc, "
        f"{_cell('start_lon', 'start_lat')} AS cell_id FROM ride_pairs) c")
    q["travel_time_scored"] = _with(RIDE_PAIRS, SAMPLES, f"""model AS (
  SELECT bucket, round(CASE WHEN count(*) >= 2 AND sum(distance * distance) >= {MIN_SUM_XX}
                            THEN sum(distance * travel_minutes) / sum(distance * distance) END, 6)
           AS slope FROM samples GROUP BY bucket)""") + (
        "SELECT ride_id, s.bucket, COALESCE(TRY_CAST(trunc(slope * distance) AS INTEGER), -1) "
        "AS predicted FROM samples s LEFT JOIN model m ON s.bucket = m.bucket")
    q["fare_lines_roundtrip"] = _with(ALL_FARES) + (
        "SELECT ride_id, taxi_id, driver_id, date_trunc('second', start_time) AS start_time, "
        "payment_type, tip, tolls, total_fare FROM fares_for_rides")
    q["line_rejects"] = _with(ALL_FARES) + (
        "SELECT ride_id, CAST(CASE WHEN ride_id % 5 = 0 THEN 6 ELSE 8 END AS INTEGER) AS fields "
        "FROM fares_for_rides WHERE ride_id % 5 = 0 OR ride_id % 7 = 0")
    place = "CASE WHEN is_start THEN start_{0} ELSE end_{0} END"
    q["ride_distance_to_point"] = base + (
        f"SELECT ride_id, is_start, round({D(110.25)} * sqrt(dx * dx + dy * dy), 6) AS distance "
        f"FROM (SELECT ride_id, is_start, CAST(CAST(40.75 AS FLOAT) - lat AS DOUBLE) AS dx, "
        f"CAST(CAST(-73.9 AS FLOAT) - lon AS DOUBLE) * cos(CAST(lat AS DOUBLE)) AS dy "
        f"FROM (SELECT ride_id, is_start, {place.format('lon')} AS lon, "
        f"{place.format('lat')} AS lat FROM rides) p) d")
    q["ride_cells_on_way"] = _ride_cells_sql()
    q["record_lines"] = (
        "SELECT CASE WHEN event_type = 'view' THEN 'Customer(' ELSE 'Trade(' END "
        "|| CAST(epoch_us(ts) // 1000 AS VARCHAR) || ') ' || CAST(event_id AS VARCHAR) AS value "
        "FROM events WHERE event_type IN ('view', 'purchase')")
    lines = f"""car_lines AS (
  SELECT event_id AS id, user_id AS car_id, date_trunc('second', ts) AS ts,
         CASE WHEN event_id % 7 = 0 THEN CAST(0 AS FLOAT) ELSE {_lon('event_id')} END AS longitude,
         CASE WHEN event_id % 7 = 0 THEN CAST(0 AS FLOAT) ELSE {_lat('user_id')} END AS latitude,
         CAST(0 AS FLOAT) AS consumption,
         CASE WHEN event_id % 5 = 0 OR event_type = 'error' THEN CAST(0 AS FLOAT)
              ELSE CAST(value AS FLOAT) END AS speed,
         CAST(value AS FLOAT) AS throttle, CAST(0.5 AS FLOAT) AS engineload,
         event_id % 13 <> 0 AS accepted FROM events)"""
    columns = ["ts", "longitude", "latitude", "consumption", "speed", "throttle", "engineload"]
    q["car_event_lines"] = _with(lines) + (
        "SELECT CAST(id AS VARCHAR) AS id, CASE WHEN accepted THEN CAST(car_id AS VARCHAR) END AS car_id, "
        + ", ".join(f"CASE WHEN accepted THEN {c} END AS {c}" for c in columns)
        + ", accepted FROM car_lines")
    q["car_event_renderings"] = _with(lines) + (
        "SELECT concat_ws(',', id, epoch_us(ts) // 1000, longitude, latitude, speed, throttle, "
        "engineload) AS value FROM car_lines WHERE accepted")
    q["segment_lines"] = (
        "SELECT concat(epoch_us(start_time) // 1000, ',', length, ' events,', "
        "coalesce(CAST(max_speed AS VARCHAR), 'null'), ' kph,', coalesce(label, 'null')) AS value "
        f"FROM ({q['gap_segments']}) s")
    q["enriched_trade_lines"] = (
        "SELECT concat('EnrichedTrade(', epoch_us(trade_ts) // 1000, ') ', "
        f"coalesce(customer_info, 'null')) AS value FROM ({q['trades_asof_customers']}) e")
    taken = "ride_id % 5 <> 0 AND ride_id % 7 <> 0 AND end_time IS NOT NULL"
    q["ride_lines"] = base + (
        f"SELECT ride_id, {taken} AS accepted, CASE WHEN {taken} THEN is_start END AS is_start, "
        + ", ".join(f"CASE WHEN {taken} THEN date_trunc('second', {c}) END AS {c}"
                    for c in ("start_time", "end_time"))
        + f", CASE WHEN {taken} THEN start_lon END AS start_lon, "
        f"CASE WHEN {taken} THEN end_lat END AS end_lat FROM rides")
    q["keyed_records"] = (
        "SELECT CASE WHEN event_type = 'purchase' THEN 'trades' ELSE 'customers' END AS kind, "
        "user_id AS customer_id, CASE WHEN event_id % 9 <> 0 THEN CAST(event_id AS VARCHAR) END AS info, "
        "CASE WHEN event_id % 9 <> 0 THEN date_trunc('millisecond', ts) END AS ts "
        "FROM events WHERE event_type IN ('view', 'purchase')")
    q["point_projections"] = "SELECT ts, upper(event_type) AS key, value * 2 AS value FROM events"
    return q

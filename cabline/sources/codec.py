"""Text lines and message values <-> ride / fare / car-event rows.

Parsing is plain column expressions over a string column, so the same code
decodes a text file, a streaming text source or the ``value`` of any
message-bus DataFrame.  Rules kept from the original records:

* trailing empty fields are dropped before counting (Java ``split``), so a
  fare whose last field is empty has 7 fields and is rejected;
* START lines carry (start, end) in fields 2-3, END lines (end, start);
* an empty float field is 0.0; other bad numbers make the record invalid;
* instants are ``yyyy-MM-dd HH:mm:ss`` in UTC.

``mode='fail'`` raises on the first invalid record (like the original);
``mode='quarantine'`` returns ``(good, bad)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.schemas import LINE_TIME_FORMAT

# Field positions of the 23-field car-event line.
CAR_FIELDS = {"car_id": 0, "id": 1, "consumption": 7, "speed": 9, "throttle": 12,
              "engineload": 19, "longitude": 20, "latitude": 21, "time": 22}
CAR_SPLIT = r"(,|;)\s*"
CAR_TRAILING = ",; \t"
CAR_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[XXX][XX]"


def _split(value: Column, sep_regex: str, trailing: str) -> Column:
    """Split like Java's ``String.split``: trailing empty fields are dropped.

    ``trailing`` are the characters a run of trailing separators consists of;
    trimming them is a plain character scan (no regex per row).
    """
    return F.split(F.rtrim(value, F.lit(trailing)), sep_regex, -1)


def _float(tok: Column) -> Column:
    return F.when(tok == F.lit(""), F.lit(0.0).cast("float")).otherwise(tok.try_cast("float"))


def _time(tok: Column, fmt: str = LINE_TIME_FORMAT) -> Column:
    return F.try_to_timestamp(tok, F.lit(fmt))


def _tokenised(lines: DataFrame, value: str, sep_regex: str,
               trailing: str) -> tuple[DataFrame, Column]:
    """Split every line once (its own projection), so fields reuse the same array."""
    df = lines.select(F.col(value), _split(F.col(value), sep_regex, trailing).alias("__tok"))
    return df, F.col("__tok")


def _finish(lines: DataFrame, shape: Column, parsed: dict[str, Column], mode: str, value: str):
    """Parse every field once, then validate on the parsed columns."""
    df = lines.select(F.col(value), shape.alias("__shape"),
                      *[c.alias(n) for n, c in parsed.items()])
    cols = list(parsed)
    valid = F.col("__shape")
    for n in cols:
        valid = valid & F.col(n).isNotNull()
    valid = F.coalesce(valid, F.lit(False))
    if mode == "fail":
        check = F.when(valid, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("Invalid record: "), F.col(value))).cast("boolean"))
        return df.where(check).select(*cols)
    if mode == "quarantine":
        good = df.where(valid).select(*cols)
        bad = df.where(~valid | valid.isNull()).select(F.col(value).alias("line"))
        return good, bad
    raise ValueError(f"unknown mode {mode!r}")


def parse_rides(lines: DataFrame, value: str = "value", mode: str = "fail"):
    lines, tok = _tokenised(lines, value, ",", ",")
    t = [F.get(tok, i) for i in range(11)]
    is_start = t[1] == F.lit("START")
    t1, t2 = _time(t[2]), _time(t[3])
    parsed = {
        "ride_id": t[0].try_cast("long"),
        "is_start": is_start,
        "start_time": F.when(is_start, t1).otherwise(t2),
        "end_time": F.when(is_start, t2).otherwise(t1),
        "start_lon": _float(t[4]), "start_lat": _float(t[5]),
        "end_lon": _float(t[6]), "end_lat": _float(t[7]),
        "passenger_cnt": t[8].try_cast("short"),
        "taxi_id": t[9].try_cast("long"),
        "driver_id": t[10].try_cast("long"),
    }
    shape = (F.size(tok) == 11) & t[1].isin("START", "END")
    return _finish(lines, shape, parsed, mode, value)


def parse_fares(lines: DataFrame, value: str = "value", mode: str = "fail"):
    lines, tok = _tokenised(lines, value, ",", ",")
    t = [F.get(tok, i) for i in range(8)]
    parsed = {
        "ride_id": t[0].try_cast("long"),
        "taxi_id": t[1].try_cast("long"),
        "driver_id": t[2].try_cast("long"),
        "start_time": _time(t[3]),
        "payment_type": t[4],
        "tip": _float(t[5]), "tolls": _float(t[6]), "total_fare": _float(t[7]),
    }
    return _finish(lines, F.size(tok) == 8, parsed, mode, value)


def parse_car_events(lines: DataFrame, value: str = "value", mode: str = "fail"):
    lines, tok = _tokenised(lines, value, CAR_SPLIT, CAR_TRAILING)
    t = {n: F.get(tok, i) for n, i in CAR_FIELDS.items()}
    parsed = {
        "id": t["id"], "car_id": t["car_id"],
        "ts": _time(t["time"], CAR_TIME_FORMAT),
        "longitude": _float(t["longitude"]), "latitude": _float(t["latitude"]),
        "consumption": _float(t["consumption"]), "speed": _float(t["speed"]),
        "throttle": _float(t["throttle"]), "engineload": _float(t["engineload"]),
    }
    return _finish(lines, F.size(tok) == 23, parsed, mode, value)


def _fmt_time(c: Column) -> Column:
    return F.date_format(c, LINE_TIME_FORMAT)


def _line(parts: list[Column]) -> Column:
    """Comma-joined fields; a null is an empty field, so that no later field moves."""
    return F.concat_ws(",", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def ride_line(rides: DataFrame) -> Column:
    """Text line of a ride in the input layout (END rows write end, start).

    Nulls are empty fields: an empty coordinate reads as 0.0, a line with any other
    empty field is rejected when read."""
    s = F.col("is_start")
    first = F.when(s, F.col("start_time")).otherwise(F.col("end_time"))
    second = F.when(s, F.col("end_time")).otherwise(F.col("start_time"))
    tag = F.when(s, F.lit("START")).when(~s, F.lit("END"))
    return _line([F.col("ride_id"), tag, _fmt_time(first), _fmt_time(second),
                  *[F.col(c) for c in ["start_lon", "start_lat", "end_lon", "end_lat",
                                       "passenger_cnt", "taxi_id", "driver_id"]]])


def fare_line(fares: DataFrame) -> Column:
    """Text line of a fare; nulls as in :func:`ride_line`."""
    return _line([F.col("ride_id"), F.col("taxi_id"), F.col("driver_id"),
                  _fmt_time(F.col("start_time")),
                  *[F.col(c) for c in ["payment_type", "tip", "tolls", "total_fare"]]])


# Columns of a ride whose nulls no line can carry (an empty coordinate would read as 0.0).
RIDE_REQUIRED = ["ride_id", "is_start", "start_time", "end_time", "start_lon", "start_lat",
                 "end_lon", "end_lat", "passenger_cnt", "taxi_id", "driver_id"]


def encode_rides(rides: DataFrame, mode: str = "fail"):
    """Message values (binary UTF-8 lines) for a message bus sink.

    A message has no null: ``mode='fail'`` raises on a ride with a null field,
    ``mode='quarantine'`` returns ``(messages, rides with a null field)``."""
    message = ride_line(rides).cast("binary").alias("value")
    whole = F.lit(True)
    for c in RIDE_REQUIRED:
        whole = whole & F.col(c).isNotNull()
    if mode == "fail":
        check = F.when(whole, F.lit(True)).otherwise(F.raise_error(F.concat(
            F.lit("Ride with a null field: "), ride_line(rides))).cast("boolean"))
        return rides.where(check).select(message)
    if mode == "quarantine":
        return rides.where(whole).select(message), rides.where(~whole)
    raise ValueError(f"unknown mode {mode!r}")


def decode_rides(messages: DataFrame, value: str = "value", mode: str = "fail"):
    return parse_rides(messages.select(F.col(value).cast("string").alias("value")), "value", mode)

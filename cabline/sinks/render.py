"""Text renderings of records, one ``value`` string column for the text sinks.

Instants print as epoch milliseconds where the original records hold longs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.operators.enrich import MATCHED, UNMATCHED_RIDE
from cabline.operators.scan import epoch_micros
from cabline.sources.codec import fare_line, ride_line

# Line layouts of the original records' text forms.
CAR_EVENT_FIELDS = ["id", "ts", "longitude", "latitude", "speed", "throttle", "engineload"]
SEGMENT_FORMAT = "%s,%s events,%s kph,%s"
TRADE_FORMAT = "Trade(%s) %s"
CUSTOMER_FORMAT = "Customer(%s) %s"
ENRICHED_TRADE_FORMAT = "EnrichedTrade(%s) %s"
DATA_POINT_FORMAT = "DataPoint(timestamp=%s, value=%s)"


def epoch_ms(ts) -> Column:
    us = epoch_micros(ts)
    return ((us - F.pmod(us, F.lit(1000))) / F.lit(1000)).cast("long")


def _str(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit("null"))


def _out(df: DataFrame, line: Column) -> DataFrame:
    return df.select(line.alias("value"))


def rides(df: DataFrame) -> DataFrame:
    return _out(df, ride_line(df))


def fares(df: DataFrame) -> DataFrame:
    return _out(df, fare_line(df))


def car_events(df: DataFrame) -> DataFrame:
    parts = [_str(epoch_ms("ts")) if c == "ts" else _str(c) for c in CAR_EVENT_FIELDS]
    return _out(df, F.concat_ws(",", *parts))


def segments(df: DataFrame) -> DataFrame:
    return _out(df, F.format_string(SEGMENT_FORMAT, _str(epoch_ms("start_time")), _str("length"),
                                    _str("max_speed"), _str("label")))


def trades(df: DataFrame) -> DataFrame:
    return _out(df, F.format_string(TRADE_FORMAT, _str(epoch_ms("ts")), _str("trade_info")))


def customers(df: DataFrame) -> DataFrame:
    return _out(df, F.format_string(CUSTOMER_FORMAT, _str(epoch_ms("ts")), _str("customer_info")))


def enriched_trades(df: DataFrame) -> DataFrame:
    return _out(df, F.format_string(ENRICHED_TRADE_FORMAT, _str(epoch_ms("ts")),
                                    _str("customer_info")))


def keyed_points(df: DataFrame) -> DataFrame:
    return _out(df, F.concat_ws(",", _str(epoch_ms("ts")), _str("key"), _str("value")))


def points(df: DataFrame) -> DataFrame:
    return _out(df, F.format_string(DATA_POINT_FORMAT, _str(epoch_ms("ts")), _str("value")))


def _pair_sides(df: DataFrame, *keep: str) -> DataFrame:
    """The ride's line as ``__ride`` beside the fare's columns under their own names."""
    fare = {"fare_ride_id": "ride_id", "fare_taxi_id": "taxi_id", "fare_driver_id": "driver_id",
            "fare_start_time": "start_time"}
    return df.select(*keep, ride_line(df).alias("__ride"),
                     *[F.col(c).alias(n) for c, n in fare.items()],
                     "payment_type", "tip", "tolls", "total_fare")


def _pair_line(p: DataFrame) -> Column:
    return F.concat(F.lit("("), F.col("__ride"), F.lit(","), fare_line(p), F.lit(")"))


def expiring_lines(df: DataFrame) -> DataFrame:
    """(outcome, value): the pair's, the ride's or the fare's whole line, by ``outcome``."""
    p = _pair_sides(df, "outcome")
    line = (F.when(F.col("outcome") == MATCHED, _pair_line(p))
            .when(F.col("outcome") == UNMATCHED_RIDE, F.col("__ride")).otherwise(fare_line(p)))
    return p.select("outcome", line.alias("value"))


def ride_fare_pairs(df: DataFrame) -> DataFrame:
    """``(ride,fare)`` lines of joined pairs (needs the fare's ``fare_taxi_id``/``fare_driver_id``)."""
    p = _pair_sides(df.withColumn("fare_ride_id", F.col("ride_id")))
    return _out(p, _pair_line(p))

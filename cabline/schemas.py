"""Record schemas (explicit StructTypes, nothing inferred)."""

from pyspark.sql import types as T

RIDE = T.StructType([
    T.StructField("ride_id", T.LongType()),
    T.StructField("is_start", T.BooleanType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("start_lon", T.FloatType()),
    T.StructField("start_lat", T.FloatType()),
    T.StructField("end_lon", T.FloatType()),
    T.StructField("end_lat", T.FloatType()),
    T.StructField("passenger_cnt", T.ShortType()),
    T.StructField("taxi_id", T.LongType()),
    T.StructField("driver_id", T.LongType()),
])

FARE = T.StructType([
    T.StructField("ride_id", T.LongType()),
    T.StructField("taxi_id", T.LongType()),
    T.StructField("driver_id", T.LongType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("tip", T.FloatType()),
    T.StructField("tolls", T.FloatType()),
    T.StructField("total_fare", T.FloatType()),
])

CAR_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("car_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("longitude", T.FloatType()),
    T.StructField("latitude", T.FloatType()),
    T.StructField("consumption", T.FloatType()),
    T.StructField("speed", T.FloatType()),
    T.StructField("throttle", T.FloatType()),
    T.StructField("engineload", T.FloatType()),
])

# Customers and trades: event time in epoch milliseconds as in the source records.
CUSTOMER = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_info", T.StringType()),
])

TRADE = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("trade_info", T.StringType()),
])

POINT = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# Field names of the 11-field ride line and 8-field fare line, in file order.
# START rows carry (start, end) in fields 2 and 3, END rows carry (end, start).
RIDE_LINE_FIELDS = ["ride_id", "tag", "time1", "time2", "start_lon", "start_lat",
                    "end_lon", "end_lat", "passenger_cnt", "taxi_id", "driver_id"]
FARE_LINE_FIELDS = ["ride_id", "taxi_id", "driver_id", "start_time", "payment_type",
                    "tip", "tolls", "total_fare"]

# Fixed value: the instant format of ride and fare lines (UTC).
LINE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

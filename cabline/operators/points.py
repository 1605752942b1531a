"""Time-stamped measurement points: projections (new value / key) and line rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.operators.scan import epoch_micros


def with_value(points: DataFrame, value: Column) -> DataFrame:
    return points.withColumn("value", value)


def with_key(points: DataFrame, key: Column) -> DataFrame:
    return points.withColumn("key", key)


def with_key_and_value(points: DataFrame, key: Column, value: Column) -> DataFrame:
    return points.withColumns({"key": key, "value": value})


def _escape(c: Column, chars: str) -> Column:
    for ch in chars:
        c = F.replace(c, F.lit(ch), F.lit("\\" + ch))
    return c


def line_protocol(points: DataFrame, measurement: str, field: str = "value",
                  key: str | None = "key", ts: str = "ts", mode: str = "fail"):
    """One measurement line per point: ``m[,key=K] field=V <epoch ms>``.

    Measurement names escape commas and blanks, field names and tag values
    commas, equals signs and blanks.  A null key writes no tag.  A value (or
    time) that is null, NaN or infinite has no line: ``mode='fail'`` ends the
    job, ``'quarantine'`` returns ``(lines, rejected points)``.
    """
    value = F.col("value").cast("double")
    valid = F.coalesce(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.lit(False)) \
        & F.col(ts).isNotNull()
    if mode == "quarantine":
        return (line_protocol(points.where(valid), measurement, field, key, ts),
                points.where(~valid))
    if mode != "fail":
        raise ValueError(f"unknown mode {mode!r}")
    points = points.where(F.when(valid, F.lit(True)).otherwise(
        F.raise_error(F.lit("Invalid measurement value")).cast("boolean")))
    m = _escape(F.lit(measurement), ", ")
    us = epoch_micros(ts)
    ts_ms = ((us - F.pmod(us, F.lit(1000))) / F.lit(1000)).cast("long").alias("ts_ms")
    tag = F.lit("")
    if key is not None and key in points.columns:
        tag = F.when(F.col(key).isNull(), F.lit("")).otherwise(
            F.concat(F.lit(",key="), _escape(F.col(key), ",= ")))
    line = F.concat(m, tag, F.lit(" "), _escape(F.lit(field), ",= "), F.lit("="), F.col("value").cast("string"),
                    F.lit(" "), ts_ms.cast("string"))
    cols = [ts_ms]
    if key is not None and key in points.columns:
        cols.append(F.col(key))
    return points.select(*cols, F.col("value"), line.alias("line"))

"""Batch readers of the record files (gzip text is read transparently).

A gzip file is not splittable: one task reads it.  For large inputs keep many
files, or convert once to Parquet with ``to_parquet`` and read that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cabline.schemas import CUSTOMER, TRADE
from cabline.session import ensure_required_conf
from cabline.sources import codec


def _lines(spark: SparkSession, path: str) -> DataFrame:
    ensure_required_conf(spark)
    return spark.read.text(path)


def read_rides(spark: SparkSession, path: str, mode: str = "fail"):
    return codec.parse_rides(_lines(spark, path), mode=mode)


def read_fares(spark: SparkSession, path: str, mode: str = "fail"):
    return codec.parse_fares(_lines(spark, path), mode=mode)


def read_car_events(spark: SparkSession, path: str, mode: str = "fail"):
    return codec.parse_car_events(_lines(spark, path), mode=mode)


def read_keyed_events(spark: SparkSession, path: str, kind: str, fmt: str = "csv",
                      mode: str = "fail"):
    """Customer or trade tables ``(timestamp ms, customer_id, info)``; event time as ``ts``.

    A record without a readable timestamp and customer_id, or with another
    number of fields, is bad: ``mode='fail'`` ends the job, ``'quarantine'``
    returns ``(records, bad)`` with the bad CSV lines as ``line`` (other formats:
    the bad rows).  CSV records are one line each; blank lines are no records.
    """
    ensure_required_conf(spark)
    if fmt == "csv":
        return parse_keyed_events(_lines(spark, path), kind, mode)
    schema = _KEYED[kind]
    return _keyed_records(spark.read.schema(schema).format(fmt).load(path), F.lit(True),
                          schema.fieldNames(), schema.fieldNames(), mode)


_KEYED = {"customers": CUSTOMER, "trades": TRADE}


def parse_keyed_events(lines: DataFrame, kind: str, mode: str = "fail"):
    """The CSV records of :func:`read_keyed_events` from lines (a ``value`` column)."""
    schema = _KEYED[kind]
    layout = StructType([*schema.fields, StructField("__bad", StringType())])
    record = F.from_csv("value", layout.simpleString().removeprefix("struct<")
                        .removesuffix(">").replace(":", " "),
                        {"columnNameOfCorruptRecord": "__bad", "mode": "PERMISSIVE"})
    df = (lines.where(F.length(F.trim("value")) > 0)
          .select(F.col("value").alias("line"), record.alias("__r")).select("line", "__r.*"))
    return _keyed_records(df, F.col("__bad").isNull(), schema.fieldNames(), ["line"], mode)


def keyed_event_lines(records: DataFrame, kind: str) -> DataFrame:
    """CSV lines of ``(ts, customer_id, info)`` records, the layout that is read."""
    info = _KEYED[kind].fieldNames()[2]
    stamp = F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp")
    return records.select(F.to_csv(F.struct(stamp, "customer_id", info)).alias("value"))


def _keyed_records(df: DataFrame, valid, fields: list[str], shown: list[str], mode: str):
    valid = valid & F.col("timestamp").isNotNull() & F.col("customer_id").isNotNull()

    def records(rows: DataFrame) -> DataFrame:
        return rows.select(*fields).withColumn("ts", F.timestamp_millis("timestamp"))

    if mode == "quarantine":
        return records(df.where(valid)), df.where(~valid).select(*shown)
    if mode != "fail":
        raise ValueError(f"unknown mode {mode!r}")
    text = F.to_json(F.struct(*shown))
    return records(df.where(F.when(valid, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("Invalid record: "), text)).cast("boolean"))))


def to_parquet(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write parsed records once as Parquet (splittable, columnar, pushdown)."""
    out = df.repartition(partitions) if partitions else df
    out.write.mode("overwrite").parquet(path)

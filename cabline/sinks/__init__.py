"""Sinks: text lines, console, outcome routing and measurement-point files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.operators.points import line_protocol
from cabline.sinks.measurement import BATCH_POINTS, DEFAULT_DATABASE, MeasurementSource


def write_text(df: DataFrame, path: str, mode: str = "append") -> None:
    """Batch text sink: one line per row of a single string column."""
    df.select(F.col(df.columns[0]).cast("string").alias("value")).write.mode(mode).text(path)


def text_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Streaming text sink (append mode); exactly-once via the checkpoint's commit log."""
    w = (df.select(F.col(df.columns[0]).cast("string").alias("value")).writeStream
         .format("text").option("path", path).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def console_stream(df: DataFrame, checkpoint: str | None = None):
    w = df.writeStream.format("console").outputMode("append").option("truncate", "false")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


def route_outcomes(writers: dict[str, Callable[[DataFrame, int], None]],
                   column: str = "outcome") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: persist the batch once, hand each outcome to its writer.

    Used for the matched pairs and the two unmatched outputs of the expiring
    join; a writer must be idempotent per ``batch_id`` for exactly-once output.
    """
    def _route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for outcome, writer in writers.items():
                writer(batch.where(F.col(column) == outcome), batch_id)
        finally:
            batch.unpersist()
    return _route


def write_outcomes(lines: DataFrame, path: str, folders: dict[str, str],
                   column: str = "outcome") -> None:
    """Batch form of :func:`route_outcomes`, in one pass: ``lines(outcome, value)`` are written
    once, partitioned by outcome, and each partition becomes its folder below ``path``.

    An older folder is replaced; an outcome without rows gets an empty folder."""
    spark = lines.sparkSession
    staged = f"{path.rstrip('/')}/_outcomes"
    lines.select(column, "value").write.mode("overwrite").partitionBy(column).text(staged)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(staged).getFileSystem(conf)

    def at(*parts: str):
        return jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *parts]))

    for outcome, folder in folders.items():
        fs.delete(at(folder), True)
        written = at("_outcomes", f"{column}={outcome}")
        if fs.exists(written):
            fs.rename(written, at(folder))
        else:
            fs.mkdirs(at(folder))
    fs.delete(at("_outcomes"), True)


def _point_lines(points: DataFrame, measurement: str, field: str, mode: str):
    """(lines, rejects or None) of the measurement sinks."""
    found = line_protocol(points, measurement, field=field, mode=mode)
    lines, rejects = found if mode == "quarantine" else (found, None)
    return lines.select("line"), rejects


def write_points(points: DataFrame, base_path: str, measurement: str,
                 db: str = DEFAULT_DATABASE, field: str = "value", mode: str = "append",
                 invalid: str = "fail") -> DataFrame | None:
    """Measurement lines into ``<base_path>/<db>/`` (one directory per database).

    ``invalid='quarantine'`` writes the valid points and returns the others."""
    lines, rejects = _point_lines(points, measurement, field, invalid)
    lines.write.mode(mode).text(f"{base_path.rstrip('/')}/{db}")
    return rejects


def points_stream(points: DataFrame, base_path: str, measurement: str, checkpoint: str,
                  db: str = DEFAULT_DATABASE, field: str = "value", trigger: dict | None = None,
                  invalid: str = "fail"):
    """Streaming form of :func:`write_points`, exactly-once like :func:`text_stream`;
    ``invalid='quarantine'`` returns ``(query, stream of rejects)``, the latter for a sink of
    its own."""
    lines, rejects = _point_lines(points, measurement, field, invalid)
    query = text_stream(lines, f"{base_path.rstrip('/')}/{db}", checkpoint, trigger)
    return query if rejects is None else (query, rejects)


def commit_points(points: DataFrame, base_path: str, measurement: str,
                  db: str = DEFAULT_DATABASE, field: str = "value", mode: str = "append",
                  batch: int = BATCH_POINTS, invalid: str = "fail") -> DataFrame | None:
    """As :func:`write_points`, through the committed measurement source: objects of at most
    ``batch`` lines, none of them visible before the whole job has committed."""
    points.sparkSession.dataSource.register(MeasurementSource)
    lines, rejects = _point_lines(points, measurement, field, invalid)
    (lines.write.format(MeasurementSource.name()).option("path", base_path).option("db", db)
     .option("batch", batch).mode(mode).save())
    return rejects


def commit_points_stream(points: DataFrame, base_path: str, measurement: str, checkpoint: str,
                         db: str = DEFAULT_DATABASE, field: str = "value",
                         trigger: dict | None = None, batch: int = BATCH_POINTS):
    """Streaming form of :func:`commit_points`; a replayed micro-batch replaces its objects."""
    points.sparkSession.dataSource.register(MeasurementSource)
    lines, _ = _point_lines(points, measurement, field, "fail")
    w = (lines.writeStream.format(MeasurementSource.name()).option("path", base_path)
         .option("db", db).option("batch", batch).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    return (w.trigger(**trigger) if trigger else w).start()

"""The committed measurement sink, the outcomes in one pass, and J1 with expiring state."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from cabline import sinks
from cabline.operators import enrich, points, rides as R
from cabline.sources import fixtures as fx
from cabline.streaming import jobs
from cabline.streaming.sources import parquet_stream
from tests.conftest import SF_SMALL
from tests.test_streaming import _run, _stream_dir


def _points(spark, n):
    return spark.range(n).select(F.timestamp_seconds(F.col("id")).alias("ts"),
                                 F.lit("k").alias("key"), F.col("id").cast("double").alias("value"))


def _objects(path):
    return sorted(glob.glob(os.path.join(path, "**", "*.txt"), recursive=True))


def test_batches_are_committed_and_whole(spark, scratch):
    df = _points(spark, 5000).repartition(2)
    sinks.commit_points(df, scratch, "m", db="a")
    found = _objects(scratch)
    sizes = [len(open(f).read().splitlines()) for f in found]
    assert sum(sizes) == 5000 and max(sizes) == 2000
    assert not glob.glob(os.path.join(scratch, "a", "_staging*"))
    lines = sorted(x for f in found for x in open(f).read().splitlines())
    assert lines == sorted(r.line for r in points.line_protocol(df, "m").collect())
    sinks.commit_points(_points(spark, 10), scratch, "m", db="a")               # append
    assert sum(len(open(f).readlines()) for f in _objects(scratch)) == 5010
    sinks.commit_points(_points(spark, 7), scratch, "m", db="a", mode="overwrite")
    assert sum(len(open(f).readlines()) for f in _objects(scratch)) == 7


def test_a_failed_job_leaves_nothing(spark, scratch):
    df = _points(spark, 3000).repartition(3).withColumn(
        "value", F.when(F.col("value") == 2999, F.lit(None)).otherwise(F.col("value")))
    with pytest.raises(Exception, match="Invalid measurement"):
        sinks.commit_points(df, scratch, "m", batch=10)
    assert not _objects(scratch)
    rejects = sinks.commit_points(df, scratch, "m", batch=10, invalid="quarantine")
    assert rejects.count() == 1 and len(_objects(scratch)) >= 300


def test_a_stream_commits_each_batch_once(spark, scratch):
    src = os.path.join(scratch, "src")
    df = _points(spark, 400).repartition(4)
    df.write.parquet(src)
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    for _ in range(2):          # the second run has nothing new
        q = sinks.commit_points_stream(parquet_stream(spark, src, df.schema, 1), out, "m", ck,
                                       trigger={"availableNow": True})
        q.awaitTermination(120)
    names = [os.path.basename(f) for f in _objects(out)]
    assert len({n.split("-")[1] for n in names}) >= 2
    lines = [x for f in _objects(out) for x in open(f).read().splitlines()]
    assert len(lines) == len(set(lines)) == 400


def test_quarantine_of_the_line_sinks(spark, scratch):
    df = _points(spark, 5).withColumn("value", F.when(F.col("value") != 3, F.col("value")))
    rejects = sinks.write_points(df, scratch, "m", db="q", invalid="quarantine")
    assert [r.value for r in rejects.collect()] == [None]
    assert spark.read.text(os.path.join(scratch, "q")).count() == 4


def test_outcomes_are_written_in_one_pass(spark, scratch):
    lines = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "outcome string, value string")
    folders = {"a": "as", "b": "bs", "c": "cs"}
    for _ in range(2):          # an older output is replaced
        sinks.write_outcomes(lines, scratch, folders)
    assert sorted(os.listdir(scratch)) == ["as", "bs", "cs"]
    assert sorted(r.value for r in spark.read.text(os.path.join(scratch, "as")).collect()) == ["1", "3"]
    assert not os.listdir(os.path.join(scratch, "cs"))


def test_rides_with_fares_expiring(spark, scratch):
    """Every ride and fare comes out once: paired within the gap, else unmatched."""
    ev = fx.load_events(spark, SF_SMALL)
    r = R.start_events(fx.rides(ev))
    for c in ("start_time", "end_time"):
        r = r.withColumn(c, F.col(c).cast("timestamp"))
    # every eleventh fare is five seconds off, every thirteenth an hour, some are missing
    f = fx.fares_for_rides(ev).withColumn("start_time", F.col("start_time").cast("timestamp"))
    f = f.withColumn("start_time", F.when(F.col("ride_id") % 13 == 0,
                                          F.col("start_time") + F.expr("INTERVAL 1 HOUR"))
                     .otherwise(F.col("start_time")))
    far = dt.datetime(2030, 1, 1)
    ends = []
    for df, times in ((r, ["start_time", "end_time"]), (f, ["start_time"])):
        end = df.limit(1).toPandas()
        end["ride_id"] = -1
        for t in times:
            end[t] = far
        ends.append(end)
    rd, rs = _stream_dir(spark, scratch, "rides", r, "start_time", ends[0])
    fd, fs = _stream_dir(spark, scratch, "fares", f, "start_time", ends[1])
    out = jobs.rides_with_fares_expiring(parquet_stream(spark, rd, rs, 1),
                                         parquet_stream(spark, fd, fs, 1), 10)
    got = _run(out, "j1_expiring", os.path.join(scratch, "ck")).where("coalesce(ride_id, 0) >= 0")
    got = sorted((x.outcome, x.ride_id if x.ride_id is not None else x.fare_ride_id)
                 for x in got.collect())
    want = sorted((x.outcome, x.key_ride_id)
                  for x in enrich.match_with_expiry(r, f, max_wait_seconds=10).collect())
    assert got == want and len({o for o, _ in got}) == 3

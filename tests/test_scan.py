"""The bucketed scan equals a plain per-key window, also with a hot key.

Input: events, with a third of the rows moved onto one key.
"""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cabline.operators.scan import (BUCKET, PROBE_SECONDS, auto_bucket_seconds,
                                    densest_bucket_rows, exact, ranked_buckets,
                                    segmented_scan, time_bucket)
from cabline.sources import fixtures as fx
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def hot(spark):
    ev = fx.load_events(spark, SF_CHECK)
    return ev.select(F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("k"),
                     "ts", "event_id", "value", "event_type")


@pytest.mark.parametrize("width", [7.5, 600, 86400, 30 * 86400])
def test_running_sum_and_last_match_window(spark, hot, width):
    order = [F.col("ts"), F.col("event_id")]
    got = segmented_scan(hot, ["k"], order, time_bucket("ts", width),
                         sums={"n": F.lit(1).cast("long"), "v": F.col("value")},
                         lasts={"last_view": F.when(F.col("event_type") == "view", F.col("event_id"))},
                         inclusive=False)
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    want = hot.select("event_id",
                      F.coalesce(F.count(F.lit(1)).over(w), F.lit(0)).alias("n"),
                      F.coalesce(F.sum("value").over(w), F.lit(0.0)).alias("v"),
                      F.last(F.when(F.col("event_type") == "view", F.col("event_id")),
                             ignorenulls=True).over(w).alias("last_view"))
    j = got.select("event_id", F.col("n").alias("n1"), F.col("v").alias("v1"),
                   F.col("last_view").alias("l1")).join(want, "event_id")
    assert j.count() == hot.count()
    bad = j.where((F.col("n1") != F.col("n")) | (F.abs(F.col("v1") - F.col("v")) > 1e-6)
                  | ~F.col("l1").eqNullSafe(F.col("last_view")))
    assert bad.count() == 0


def test_hot_key_is_split_over_partitions(spark, hot):
    """The per-(key, bucket) window spreads the hot key over many partitions."""
    b = hot.where("k = 0").select(time_bucket("ts", 86400).alias("b")).distinct().count()
    assert b >= 28


def test_auto_width_bounds_every_key_bucket(spark, hot):
    """The chosen width keeps every (key, bucket) at or below the target, hot key included."""
    densest = int(densest_bucket_rows(hot, ["k"], "ts"))
    assert densest >= 1
    target = densest * 3
    width = auto_bucket_seconds(hot, ["k"], "ts", target_rows=target, fraction=1.0)
    assert width == 3 * PROBE_SECONDS
    top = hot.groupBy("k", time_bucket("ts", width).alias("b")).count() \
        .agg(F.max("count")).first()[0]
    assert top <= target
    # a target below the densest minute gives a sub-minute width
    assert auto_bucket_seconds(hot, ["k"], "ts", target_rows=1, fraction=1.0) \
        <= PROBE_SECONDS / densest
    # sparse input: capped at one day (sampled probe, the default)
    assert auto_bucket_seconds(hot, ["k"], "ts", target_rows=10**9) == 86400


def test_sampled_probe_finds_a_dense_key(spark):
    """A key with far more rows per minute than the rest is found by the 1% probe."""
    from cabline.operators.scan import PROBE_FRACTION
    dense = spark.range(200_000).select((F.col("id") % 7).alias("k"),
                                        F.timestamp_seconds(F.col("id") % 60).alias("ts"))
    exact = densest_bucket_rows(dense, ["k"], "ts")
    sampled = densest_bucket_rows(dense, ["k"], "ts", fraction=PROBE_FRACTION)
    assert exact == 28572
    assert 0.7 * exact < sampled < 1.3 * exact


def test_order_key_gives_the_same_result_with_a_hash_summary(spark, hot):
    order = [F.col("ts"), F.col("event_id")]
    lasts = {"last_view": F.when(F.col("event_type") == "view", F.col("event_id"))}
    key = F.col("event_id")      # ts never decreases in event_id order (FIXTURES.md §4)
    a = segmented_scan(hot, ["k"], order, time_bucket("ts", 3600), lasts=lasts, inclusive=False)
    b = segmented_scan(hot, ["k"], order, time_bucket("ts", 3600), lasts=lasts, inclusive=False,
                       order_key=key)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    diff = a.select("event_id", "last_view").exceptAll(b.select("event_id", "last_view"))
    assert diff.count() == 0 and b.count() == hot.count()


def _two_seconds(spark, n=300_000):
    """One key with all its rows in two seconds, half of them at one instant."""
    at = F.when(F.col("id") % 2 == 0, F.lit(1_700_000_000.0)).otherwise(
        1_700_000_000.0 + (F.col("id") % 2000) / 1000.0)
    return spark.range(n).select("id", F.lit(7).cast("long").alias("k"),
                                 F.timestamp_micros((at * 1_000_000).cast("long")).alias("ts"),
                                 ((F.col("id") * 7919) % 1000 / 7.0).alias("v"))


def test_ties_of_one_instant_are_split(spark):
    df, order = _two_seconds(spark), [F.col("ts"), F.col("id")]
    sizes = [r["count"] for r in ranked_buckets(df, ["k"], order, range_rows=2000)
             .groupBy(BUCKET).count().collect()]
    assert sum(sizes) == 300_000 and len(sizes) > 80
    assert max(sizes) < 2000 * 12
    one = ranked_buckets(df.where("id % 2 = 0"), ["k"], order, range_rows=2000)
    assert one.select(BUCKET).distinct().count() > 40


def test_ranges_follow_the_order(spark):
    df, order = _two_seconds(spark, 20_000), [F.col("ts"), F.col("id")]
    b = ranked_buckets(df, ["k"], order, range_rows=100)
    w = Window.partitionBy("k").orderBy(*order)
    before = b.withColumn("prev", F.lag(BUCKET).over(w))
    assert before.where(F.col("prev") > F.col(BUCKET)).count() == 0
    got = segmented_scan(b, ["k"], order, BUCKET, sums={"n": F.lit(1).cast("long")})
    assert got.join(df.withColumn("want", F.row_number().over(w)), "id").where(
        "n <> want").count() == 0


def test_building_a_scan_runs_no_job(spark):
    from cabline.plans.queries import QUERIES
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-scan", "build only")
    try:
        for name in ["ride_event_order", "trades_asof_customers", "stopped_segments",
                     "travel_time_predictions"]:
            QUERIES[name](spark, SF_CHECK)
        # reading a Parquet file's schema is the only job of a build
        built = len(tracker.getJobIdsForGroup("lazy-scan"))
        spark.sparkContext.setJobGroup("lazy-scan-read", "schemas only")
        for _ in range(4):
            fx.load_events(spark, SF_CHECK)
        assert built <= len(tracker.getJobIdsForGroup("lazy-scan-read"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_exact_sums_do_not_depend_on_the_split(spark):
    df, order = _two_seconds(spark, 20_000), [F.col("ts"), F.col("id")]
    v = F.col("v") * F.lit(0.1) + F.lit(1e-7)

    def sums(bucketed):
        out = segmented_scan(bucketed, ["k"], order, BUCKET, sums={"s": exact(v)}, inclusive=False)
        return sorted((r.id, r.s) for r in out.select("id", F.col("s").cast("double")).collect())

    whole = sums(df.withColumn(BUCKET, F.lit(0).cast("long")))
    for rows in (1, 37, 4000):
        assert sums(ranked_buckets(df, ["k"], order, range_rows=rows)) == whole


def test_ranges_with_null_keys_and_instants(spark):
    rows = [(i, None if i % 3 == 0 else i % 2, None if i % 5 == 0 else i % 7) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k long, s long").select(
        "id", "k", F.timestamp_seconds("s").alias("ts"))
    order = [F.col("ts"), F.col("id")]
    w = Window.partitionBy("k").orderBy(*order)
    want = {r.id: r.n for r in df.withColumn("n", F.row_number().over(w)).collect()}
    for n in (1, 10, 10**6):
        got = segmented_scan(ranked_buckets(df, ["k"], order, range_rows=n), ["k"], order, BUCKET,
                             sums={"n": F.lit(1).cast("long")})
        assert {r.id: r.n for r in got.collect()} == want

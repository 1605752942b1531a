"""Plan guards: native geography, pruned scans, broadcast only of bounded sides."""

from cabline.operators import traveltime
from cabline.plans.queries import QUERIES
from cabline.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_geography_has_no_python(spark):
    for name in ["ride_cleansing", "rides_per_cell", "ride_distance_direction",
                 "travel_time_model", "travel_time_predictions", "gap_segments"]:
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "Python" not in p, name


def test_path_walk_is_arrow_batched(spark):
    p = _plan(QUERIES["cell_traffic"](spark, SF_SMALL))
    assert "ArrowEvalPython" in p
    assert "BatchEvalPython" not in p


def test_scans_read_only_needed_columns(spark):
    df = QUERIES["hourly_tips"](spark, SF_SMALL)
    df.explain()
    p = _plan(df)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_filters_reach_the_scan(spark):
    p = _plan(fx.customers(fx.load_events(spark, SF_SMALL)))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in p


def test_model_is_broadcast(spark):
    s = traveltime.travel_samples(fx.ride_pairs(fx.load_events(spark, SF_SMALL)))
    p = _plan(traveltime.predict(traveltime.fit_model(s), s))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_no_pairwise_joins(spark):
    for name in QUERIES:
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_asof_is_one_window_scan_not_a_range_join(spark):
    p = _optimized(QUERIES["trades_asof_customers"](spark, SF_SMALL))
    assert "Window" in p and "Union" in p


def test_no_query_funnels_rows_into_one_task(spark):
    """No plan moves all rows into one task.

    An unpartitioned window, a global sort-free aggregate over raw rows or a
    global limit all show up as a single-partition exchange.
    """
    for name in QUERIES:
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "SinglePartition" not in p, name


def test_scan_join_back_reuses_the_row_partitioning(spark):
    """Without broadcasts the summary joins back on the rows' own partitioning: the
    rows are shuffled once, never again on rewritten (null-safe) keys."""
    old = {k: spark.conf.get(k) for k in ["spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.enabled"]}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(QUERIES["ride_event_order"](spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    exchanges = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert "SortMergeJoin" in p
    assert not any("coalesce(" in line or "isnull(" in line for line in exchanges)
    row_side = [line for line in exchanges if "__bucket" in line]
    assert len(row_side) == 3   # rows once; summary aggregate; prefix to the join


def test_no_null_id_branch_for_non_nullable_ids(spark):
    from pyspark.sql import functions as F

    from cabline.operators import enrich, rides as R
    ev = fx.load_events(spark, SF_SMALL)
    r, f = fx.rides(ev), fx.fares_for_rides(ev)
    nn = lambda df: df.withColumn("ride_id", F.coalesce("ride_id", F.lit(-1)))
    scans = lambda df: _plan(df).count("FileScan parquet")                      # noqa: E731
    with_branch = enrich.unmatched_rides(enrich.match_with_expiry(R.start_events(r), f))
    without = enrich.unmatched_rides(enrich.match_with_expiry(R.start_events(nn(r)), nn(f)))
    assert scans(without) < scans(with_branch)


def test_walk_steps_are_never_broadcast(spark):
    """Spark's estimate of the exploded walk steps is far too small: they are shuffled."""
    p = _plan(QUERIES["cell_traffic"](spark, SF_SMALL))
    assert "SortMergeJoin" in p
    assert p.count("BroadcastExchange") == 0


def test_queries_read_whole_tables(spark):
    """No registered query caps or samples its rows (the bucket-width probe's sample is
    a separate job that only sizes buckets)."""
    for name in QUERIES:
        p = _optimized(QUERIES[name](spark, SF_SMALL))
        for node in ("Sample", "GlobalLimit", "LocalLimit", "Tail"):
            assert node not in p, (name, node)

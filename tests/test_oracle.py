"""Every driver query equals its DuckDB oracle on the sf0.01 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as se
from cabline.plans.oracle import oracle_sql
from cabline.plans.queries import QUERIES
from tests.conftest import SF_CHECK
from tools.compare import TABLES, frame_hash


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_CHECK, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(se.queries()) and set(oracle_sql()) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_CHECK).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert len(got) == len(want)
    hg, cg = frame_hash(got)
    hw, cw = frame_hash(want)
    assert cg == cw
    assert hg == hw


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["window_end", "driver_id", "tips"]
    assert df.count() > 0


SCALE_PATH_QUERIES = ["ride_event_order", "trades_asof_customers", "stopped_segments",
                      "travel_time_predictions", "gap_segments", "cell_traffic",
                      "expiring_matched", "rides_with_fares"]


@pytest.fixture()
def scale_paths(spark, monkeypatch):
    """The plans large inputs get: no broadcasts, no AQE, and buckets of a few rows."""
    import cabline.operators.scan as scan
    monkeypatch.setattr(scan, "TARGET_BUCKET_ROWS", 3)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", SCALE_PATH_QUERIES)
def test_query_matches_oracle_on_scale_paths(spark, con, scale_paths, name):
    got = QUERIES[name](spark, SF_CHECK).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)

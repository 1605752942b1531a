"""Property: the bucketed scan equals a plain per-key window on any input and width
(composite keys, null key parts, tied times, null values)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from cabline.operators.scan import segmented_scan, time_bucket

T0 = dt.datetime(2024, 1, 1)

rows_strategy = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2, None]),                 # key 0 is hot
              st.sampled_from(["a", "a", "b", None]),                  # second key part
              st.integers(0, 5000),                                    # seconds (many ties)
              st.one_of(st.none(), st.integers(-50, 50))),             # value, nullable
    min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, width=st.sampled_from([0.5, 7, 60, 900, 86400]),
       inclusive=st.booleans())
def test_scan_equals_window(spark, rows, width, inclusive):
    data = [(i, k, k2, T0 + dt.timedelta(seconds=s), v) for i, (k, k2, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k long, k2 string, ts timestamp, v long")
    order = [F.col("ts"), F.col("id")]
    got = segmented_scan(df, ["k", "k2"], order, time_bucket("ts", width),
                         sums={"s": F.col("v")}, lasts={"last_v": F.col("v")},
                         inclusive=inclusive)
    frame_end = Window.currentRow if inclusive else -1
    w = Window.partitionBy("k", "k2").orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                                   frame_end)
    want = df.select("id", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"),
                     F.last("v", ignorenulls=True).over(w).alias("last_v"))
    g = sorted((r.id, r.s, r.last_v) for r in got.select("id", "s", "last_v").collect())
    e = sorted((r.id, r.s, r.last_v) for r in want.collect())
    assert g == e

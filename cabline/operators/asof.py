"""As-of enrichment: each trade gets the latest customer record at or before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.operators.scan import AUTO, BUCKET, segmented_scan, with_buckets


def asof_enrich(trades: DataFrame, customers: DataFrame, key: str = "customer_id",
                ts: str = "ts", info: str = "customer_info",
                bucket_seconds: float | str = AUTO) -> DataFrame:
    """Left as-of join of trades to customers on ``key`` and ``customer.ts <= trade.ts``.

    Both inputs are tagged and unioned, then one bucketed scan per key carries
    the last customer record forward (customers sort before trades at equal
    times).  No range join, no pairs: one shuffle of the union plus a small
    per-bucket summary; a customer with a huge history is split over buckets.
    Adds ``customer_ts`` and ``info`` (null when there is none).
    """
    trade_cols = [c for c in trades.columns]
    t = trades.withColumn("__side", F.lit(1))
    # as in any join, a null key or time matches nothing: such customer records
    # can never be chosen (trades with them are kept, with no customer)
    c = customers.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key), F.col(ts),
                         F.struct(F.col(ts).alias("ts"), F.col(info).alias("info")).alias("__cust"),
                         F.lit(0).alias("__side"))
    u = t.unionByName(c, allowMissingColumns=True)
    # ties: of customer records at one instant the greatest info counts; trades at one
    # instant are told apart by a hash only so that they can be split
    order = [F.col(ts), F.col("__side"), F.col("__cust.info"), F.xxhash64(*trade_cols)]
    scanned = segmented_scan(with_buckets(u, [key], order, bucket_seconds), [key], order, BUCKET,
                             lasts={"__match": F.col("__cust")}, inclusive=True)
    return scanned.where(F.col("__side") == 1).select(
        *trade_cols, F.col("__match.ts").alias("customer_ts"),
        F.col("__match.info").alias(info))

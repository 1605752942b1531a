"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0 .. n-1 in the order of (id, hash of the whole row): a number
follows from the rows alone, not from files, partitions or executors.  A keyed
Feistel network permutes the 4 ** h numbers of the smallest even number of bits
that holds n; a number that lands at n or above is sent through it again until
it is below (cycle walking, under four steps on average).  That is a permutation of
0 .. n-1 that needs no table.  Position p of a row lies in shard ``p % shards`` at slot
``p // shards``: shards differ by one row at most, slots have no gaps, and both
directions are computed from the key and n alone (``position``, ``row_at``).

The order needs one range shuffle; equal rows are told apart by a running number, so
that a hot id or a thousand copies of a row are split like any other range.  Only
counts per partition leave it, one row a partition.

Cases: a null id comes first, a null text has no bytes; rows that are equal in all
columns get neighbouring numbers and are interchangeable; an empty table gives no
rows; the caller's own columns are passed on, and ``row_number``, ``shard`` and
``slot`` must not be among them (an error says so).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabline.llm._common import cut, mix64

ROUNDS = 8
ADDED = ("row_number", "shard", "slot")


class Permutation:
    """Of 0 .. n-1, fixed by ``key``."""

    def __init__(self, n: int, key: str) -> None:
        if n < 0:
            raise ValueError("n must not be negative")
        self.n, half = n, 1
        while 4 ** half < n:
            half += 1
        self.half = np.uint64(half)
        self.mask = np.uint64((1 << half) - 1)
        self.keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8],
                                              "little")) for r in range(ROUNDS)]

    def _once(self, x: np.ndarray, keys: list) -> np.ndarray:
        """One pass; with the keys reversed, its inverse (halves are swapped at the end)."""
        left, right = x >> self.half, x & self.mask
        for k in keys:
            left, right = right, left ^ (mix64(right + k) & self.mask)
        return right << self.half | left

    def _walk(self, x: np.ndarray, keys: list) -> np.ndarray:
        x = np.asarray(x, np.int64)
        if len(x) and (x.min() < 0 or x.max() >= self.n):
            raise ValueError("a number outside the permutation")
        x = self._once(x.astype(np.uint64), keys)
        out = np.flatnonzero(x >= self.n)
        while len(out):
            x[out] = self._once(x[out], keys)
            out = out[x[out] >= self.n]
        return x.astype(np.int64)

    def position(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, self.keys)

    def row(self, positions: np.ndarray) -> np.ndarray:
        return self._walk(positions, self.keys[::-1])


def place(rows: np.ndarray, n: int, shards: int, key: str) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of row numbers."""
    at = Permutation(n, key).position(rows)
    return at % shards, at // shards


def row_at(shard: int, slots: np.ndarray, n: int, shards: int, key: str) -> np.ndarray:
    """The row numbers at ``slots`` of ``shard``, as a reader that resumes needs them."""
    return Permutation(n, key).row(np.asarray(slots, np.int64) * shards + shard)


def row_numbers(df: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """``df`` with ``row_number``, and how many rows there are."""
    spark = df.sparkSession
    order = ["__id", "__h", "__g", "__tie"]
    # two hashes of the row order those of one id; the tie only splits equal rows
    named = df.select("*", F.col(id_col).cast("long").alias("__id"),
                      F.xxhash64(*df.columns).alias("__h"), F.hash(*df.columns).alias("__g"),
                      F.monotonically_increasing_id().alias("__tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut(named.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .select(*df.columns, F.spark_partition_id().alias("__part"),
                          F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
                          .alias("__at")), "ordered-rows")
    sums = ordered.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a partition, whose number is set above
    first = sums.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    n = ordered.count()
    out = ordered.join(F.broadcast(first), "__part").select(
        *df.columns, (F.col("__first") + F.col("__at")).alias("row_number"))
    return out, n


def positions(n: int, key: str, rows: Column) -> Column:
    """Column of the permuted row numbers."""
    permutation = Permutation(n, key)

    @F.pandas_udf("long")
    def permuted(found: pd.Series) -> pd.Series:
        return pd.Series(permutation.position(found.to_numpy(np.int64)))

    return permuted(rows)


def shard_rows(df: DataFrame, shards: int, key: str, id_col: str = "doc_id") -> DataFrame:
    """``df`` with row_number, shard (int) and slot (long)."""
    if shards < 1:
        raise ValueError("at least one shard")
    if clash := set(ADDED) & {c.lower() for c in df.columns}:
        raise ValueError(f"columns in the way: {sorted(clash)}")
    numbered, n = row_numbers(df, id_col)
    at = numbered.withColumn("__p", positions(n, key, F.col("row_number")))
    return at.select("*", F.pmod("__p", F.lit(shards)).cast("int").alias("shard"),
                     F.floor(F.col("__p") / F.lit(shards)).cast("long").alias("slot")).drop("__p")


def write_shards(df: DataFrame, path: str, shards: int, key: str, id_col: str = "doc_id",
                 parts: int = 8) -> None:
    """Write whole rows below ``path/shard=<s>/part=<k>``: the files of one ``(shard, part)``
    hold a contiguous range of slots, in order; ``parts`` ranges a shard are written at once."""
    placed = shard_rows(df, shards, key, id_col)
    most = placed.agg(F.coalesce(F.max("slot"), F.lit(0)).alias("m")).first()["m"] + 1
    part = F.floor(F.col("slot") * F.lit(parts) / F.lit(most)).cast("int")
    (placed.withColumn("part", part).repartition(shards * parts, "shard", "part")
     .sortWithinPartitions("shard", "part", "slot").write.partitionBy("shard", "part")
     .parquet(path))


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """One shard's rows in slot order; only its own folder is read."""
    return spark.read.parquet(path).where(F.col("shard") == shard).orderBy("slot")

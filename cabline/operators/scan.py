"""Skew-proof ordered scans per key.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of one key to a
single task; if one key holds a third of the data, one task does a third of the
work.  ``segmented_scan`` splits every key into time buckets:

1. rows are windowed per (key, bucket) -- many small, parallel partitions;
2. a per-(key, bucket) summary (one row per bucket, built with partial
   aggregation) is scanned per key to get what all *earlier* buckets carry;
3. the summary is joined back on (key, bucket) -- the row side is already
   partitioned by it, so only the small summary moves.

The result is exact: for every row the running value over all earlier rows of
its key, whatever the bucket width.  The width only trades summary size
against the size of one (key, bucket) partition.

A fixed width bounds a (key, bucket) partition only by the key's event rate:
a key with a third of 100 TB puts tens of GB into one day, or into one instant.
``ranked_buckets`` (the default of the jobs, ``AUTO``) therefore cuts each (key, day) into
ranges of the *full order*, ties included.  The cuts are rows of the input: those whose
hash falls on one in ``TARGET_BUCKET_ROWS / 8`` values, so a range holds that many rows on
average, and more than the target about once in 3,000 ranges.  Sparse
keys have no cuts at all.  Nothing is measured or collected beforehand: the cuts are part
of the plan (one row per 250,000 input rows, sorted per (key, day) and broadcast: about
25 MB per 1e11 rows), and which rows are cuts follows from the rows alone.  A key's
summary has one row per range, so one per day and 250,000 rows: 137,000 for a key of
3.3e10 rows over ten years, which one task scans in well under a second.

Rows with a null key form one group, as in a plain window; a non-null stand-in
(value with nulls replaced, plus an is-null flag) lets that group be split by
time and joined back like any other key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "__bucket"
DEFAULT_BUCKET_SECONDS = 86400
AUTO = "auto"
# Rows one task sorts and scans for one (key, bucket); sized to stay in memory.
TARGET_BUCKET_ROWS = 2_000_000
# Granularity at which the input's densest key is measured.
PROBE_SECONDS = 60
# Share of rows the width probe looks at.  The width only matters once a key has
# more than TARGET_BUCKET_ROWS / (buckets per day) ~ 1,400 rows in a minute;
# a 1% sample still holds ~14 of them, and its shuffle is 1% of the full probe's.
PROBE_FRACTION = 0.01


def epoch_micros(ts) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def time_bucket(ts, seconds: float = DEFAULT_BUCKET_SECONDS) -> Column:
    """Bucket number of an instant; monotone in time, so it can split an ordered scan."""
    width_us = max(1, int(round(float(seconds) * 1_000_000)))
    return F.floor(epoch_micros(ts) / F.lit(width_us))


def densest_bucket_rows(df: DataFrame, keys: list[str], ts, seconds: float = PROBE_SECONDS,
                        fraction: float = 1.0) -> float:
    """Largest number of rows one key has in one bucket of ``seconds`` (0 if empty).

    With ``fraction`` < 1 it is estimated from a sample of the rows (scaled
    up); the sample only sizes buckets, every row is still scanned.
    """
    src = df if fraction >= 1.0 else df.sample(withReplacement=False, fraction=fraction, seed=7)
    counts = src.groupBy(*[F.col(k) for k in keys],
                         time_bucket(ts, seconds).alias("__probe")).count()
    top = counts.agg(F.max("count").alias("m")).first()
    return float(top["m"] or 0) / min(1.0, fraction)


def auto_bucket_seconds(df: DataFrame, keys: list[str], ts,
                        target_rows: int | None = None,
                        probe_seconds: int = PROBE_SECONDS,
                        max_seconds: int = DEFAULT_BUCKET_SECONDS,
                        fraction: float | None = None) -> float:
    """Widest bucket (at most ``max_seconds``) holding about ``target_rows`` rows of any key.

    Widths of whole probe intervals are aligned with them, so with an exact
    probe (``fraction=1``) the bound is exact there; below one probe interval
    the rate inside it is taken as even.  ``target_rows`` defaults to
    ``TARGET_BUCKET_ROWS`` and ``fraction`` to ``PROBE_FRACTION``.
    """
    target_rows = TARGET_BUCKET_ROWS if target_rows is None else int(target_rows)
    fraction = PROBE_FRACTION if fraction is None else float(fraction)
    densest = densest_bucket_rows(df, keys, ts, probe_seconds, fraction)
    if densest <= 0:
        return float(max_seconds)
    if densest <= target_rows:
        return float(min(max_seconds, probe_seconds * int(target_rows // densest)))
    return max(1e-6, probe_seconds * target_rows / densest)


def with_buckets(df: DataFrame, keys: list[str], order: list, seconds) -> DataFrame:
    """``df`` with the column ``BUCKET`` for ``segmented_scan``: ranges of the order (AUTO)
    or time buckets of so many seconds.  ``order`` starts with the instant."""
    if seconds == AUTO:
        return ranked_buckets(df, keys, order)
    return df.withColumn(BUCKET, time_bucket(order[0], seconds))


# Ranges of one (key, day) are numbered below this, so day and range fit one long.
_RANGES_PER_DAY = 1 << 24
# Steps of the binary search among the cuts of one (key, day).
_SEARCH_STEPS = 24
# The day of rows without an instant, which come first.
_NO_DAY = -(1 << 38)


def _cuts_before(cuts: Column, place: Column) -> Column:
    """How many of the sorted ``cuts`` are at or before ``place`` (binary search)."""
    def step(found, _):
        middle = F.shiftright(found["low"] + found["high"], 1)
        open_, before = found["low"] < found["high"], F.get(cuts, middle) <= place
        return F.struct(F.when(open_ & before, middle + 1).otherwise(found["low"]).alias("low"),
                        F.when(open_ & ~before, middle).otherwise(found["high"]).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    steps = F.array(*[F.lit(i) for i in range(_SEARCH_STEPS)])
    return F.when(cuts.isNull(), F.lit(0)).otherwise(
        F.aggregate(steps, start, step, lambda found: found["low"]))


def ranked_buckets(df: DataFrame, keys: list[str], order: list,
                   range_rows: int | None = None) -> DataFrame:
    """``df`` with ``BUCKET``: day and range of the full order, one long that increases with
    ``order`` within a key.  ``range_rows``: rows of a range on average.

    Only rows equal in keys and order stay together, so ``order`` should end with a
    tie-breaker wherever the result allows one.
    """
    range_rows = max(1, TARGET_BUCKET_ROWS // 8) if range_rows is None else int(range_rows)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    marks = {}
    for i, k in enumerate(keys):
        marks[f"__rv{i}"], marks[f"__rn{i}"] = non_null_key(df, k)
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    marks["__day"] = F.coalesce(time_bucket(order[0]), F.lit(_NO_DAY)).cast("long")
    part = list(marks)
    marks["__place"] = place
    rows = df.withColumns(marks)
    cuts = (rows.where(F.pmod(F.xxhash64(*keys, *order), F.lit(range_rows)) == 0)
            .groupBy(*part).agg(F.array_sort(F.collect_set("__place")).alias("__cuts")))
    number = _cuts_before(F.col("__cuts"), F.col("__place"))
    out = rows.join(F.broadcast(cuts), part, "left")
    return out.withColumn(BUCKET, F.col("__day") * F.lit(_RANGES_PER_DAY) + number).drop(
        *part, "__place", "__cuts")


def exact(value: Column) -> Column:
    """A double as a decimal of 18 places: sums of it don't depend on their order, so
    running sums are the same for every split."""
    return value.cast("decimal(38,18)")


_ZERO = {T.StringType: "", T.BooleanType: False, T.DateType: "1970-01-01",
         T.TimestampType: "1970-01-01 00:00:00", T.TimestampNTZType: "1970-01-01 00:00:00"}


def non_null_key(df: DataFrame, key: str) -> tuple[Column, Column]:
    """(key with nulls replaced, is-null flag): together a non-null stand-in for the key.

    Null keys stay one group, as in a plain window, but can take part in
    equi-joins and be split by time like any other key.
    """
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.NumericType):
        zero = F.lit(0).cast(dtype)
    elif type(dtype) in _ZERO:
        zero = F.lit(_ZERO[type(dtype)]).cast(dtype)
    else:
        raise TypeError(f"unsupported key type {dtype.simpleString()} for {key}")
    return F.coalesce(F.col(key), zero), F.col(key).isNull()


def segmented_scan(df: DataFrame, keys: list[str], order: list, bucket,
                   sums: dict[str, Column] | None = None,
                   lasts: dict[str, Column] | None = None,
                   inclusive: bool = True, keep_bucket: bool = False,
                   order_key: Column | None = None) -> DataFrame:
    """Running sums and last-non-null values per key, in ``order``.

    ``order`` must start with the instant the bucket is computed from and be
    a total order within a key.  ``bucket`` is either a Column (added here) or
    the name of a column holding a bucket number (from ``time_bucket`` or
    ``scan_bucket``, monotone in ``order``).  ``inclusive`` decides
    whether the current row counts.  ``order_key``, one numeric column that
    increases with ``order``, lets the per-bucket summary of ``lasts`` with
    fixed-width values run as a hash aggregate instead of sorting its input.
    """
    sums = sums or {}
    lasts = lasts or {}
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if isinstance(bucket, str):
        b, d = bucket, df
    else:
        b, d = BUCKET, df.withColumn(BUCKET, bucket)
    # non-null stand-ins for the keys: plain equi-joins on the partitioning the
    # rows get once, and a null key is split by time like any other key
    stand_in = {}
    for i, k in enumerate(keys):
        value, is_null = non_null_key(df, k)
        stand_in[f"__kv{i}"], stand_in[f"__kn{i}"] = value, is_null
    part = [*stand_in, b]
    d = d.withColumns(stand_in)

    # (1) local scans inside (key, bucket): the only full shuffle of the rows
    w = Window.partitionBy(*part).orderBy(*order_cols)
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    local = {}
    for name, value in sums.items():
        local[f"__l_{name}"] = F.sum(value).over(w)
    for name, value in lasts.items():
        local[f"__l_{name}"] = F.last(value, ignorenulls=True).over(w)
    rows = d.withColumns(local)

    # (2) per-bucket summary from the *input* rows (map-side partial aggregation,
    #     so only one small row per bucket and task is shuffled; summarising the
    #     windowed rows instead would re-run and re-shuffle them), then its
    #     exclusive prefix over earlier buckets
    aggs = [F.sum(v).alias(f"__t_{n}") for n, v in sums.items()]
    if lasts:
        rank = order_key if order_key is not None else F.struct(*order_cols)
        aggs += [F.max_by(v, F.when(v.isNotNull(), rank)).alias(f"__t_{n}")
                 for n, v in lasts.items()]
    summary = d.groupBy(*part).agg(*aggs)
    ws = Window.partitionBy(*stand_in).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"__p_{n}": F.sum(f"__t_{n}").over(ws) for n in sums}
    carried.update({f"__p_{n}": F.last(f"__t_{n}", ignorenulls=True).over(ws) for n in lasts})
    prefix = summary.select(*part, *[c.alias(n) for n, c in carried.items()])

    # (3) join back on (key, bucket); rows are already partitioned that way
    out = rows.join(prefix, on=part, how="left")
    final = {}
    for n in sums:
        final[n] = F.coalesce(F.col(f"__l_{n}"), F.lit(0)) + F.coalesce(F.col(f"__p_{n}"), F.lit(0))
    for n in lasts:
        final[n] = F.coalesce(F.col(f"__l_{n}"), F.col(f"__p_{n}"))
    out = out.withColumns(final)
    drop = [f"__l_{n}" for n in list(sums) + list(lasts)] \
        + [f"__p_{n}" for n in list(sums) + list(lasts)] + list(stand_in)
    if not keep_bucket:
        drop.append(b)
    return out.drop(*drop)

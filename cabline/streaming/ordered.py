"""Ordered per-key streams: a reorder buffer released by the watermark.

Rows of a key wait in map state under the time bucket they belong to, as one Arrow
payload per bucket and arrival; a bucket whose end the watermark has reached can get no
more rows (Spark drops late ones), so its rows are read, sorted and handed on in order.
A timer reads the due buckets only, whatever else waits for the key, and every bucket is
written and removed once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (BinaryType, BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampType)

from cabline._shipping import ship_by_value

ship_by_value(__name__)         # runs inside Python workers without an installed package

BUCKET_SECONDS = 10
OUTPUT_CHUNK_ROWS = 10_000

_PLACE = StructType([StructField("bucket", LongType()), StructField("part", LongType())])
_PAYLOAD = StructType([StructField("rows", BinaryType())])
_BUCKET = StructType([StructField("bucket", LongType())])
_PARTS = StructType([StructField("parts", LongType())])


def to_bytes(rows: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(raw: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(raw).read_all().to_pandas()


def timestamps(us) -> pd.Series:
    """Epoch microseconds (missing: NaN or None) as instants."""
    return pd.to_datetime(pd.Series(us, dtype="Int64"), unit="us")


class ReorderBuffer:
    """Waiting rows of one key by time bucket; rows carry ``t_us``."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, width_us: int) -> None:
        self.handle, self.width = handle, width_us
        self.rows = handle.getMapState(f"{name}_rows", _PLACE, _PAYLOAD)
        self.parts = handle.getMapState(f"{name}_parts", _BUCKET, _PARTS)

    def add(self, chunk: pd.DataFrame) -> None:
        buckets = chunk["t_us"].to_numpy(np.int64) // self.width
        for bucket, part in chunk.groupby(buckets, sort=False):
            bucket = int(bucket)
            held = self.parts.containsKey((bucket,))
            n = self.parts.getValue((bucket,))[0] if held else 0
            self.rows.updateValue((bucket, n), (to_bytes(part),))
            self.parts.updateValue((bucket,), (n + 1,))
            if not held:
                self.handle.registerTimer(-(-(bucket + 1) * self.width // 1000))

    def due(self, watermark_us: int):
        """The rows of each bucket that has ended, earliest bucket first; they are removed."""
        ended = sorted(k[0] for k in self.parts.keys() if (k[0] + 1) * self.width <= watermark_us)
        for bucket in ended:
            places = [(bucket, n) for n in range(self.parts.getValue((bucket,))[0])]
            yield pd.concat([from_bytes(self.rows.getValue(p)[0]) for p in places],
                            ignore_index=True)
            for place in places:
                self.rows.removeKey(place)
            self.parts.removeKey((bucket,))


class OrderedProcessor(StatefulProcessor):
    """Base: ``start`` opens the key's own state, ``released`` gets a bucket's rows in order."""

    ORDER = ["t_us"]

    def __init__(self, bucket_seconds: float = BUCKET_SECONDS) -> None:
        self.width = max(1, int(bucket_seconds * 1_000_000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = ReorderBuffer(handle, "waiting", self.width)
        self.start(handle)

    def start(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def released(self, key: tuple, rows: pd.DataFrame) -> pd.DataFrame | None:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues):
        for chunk in rows:              # one Arrow chunk at a time
            self.buffer.add(chunk)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        reached = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        for rows in self.buffer.due(reached * 1000):
            rows = rows.sort_values(self.ORDER, kind="stable", ignore_index=True)
            out = self.released(key, rows)
            if out is not None:
                for i in range(0, len(out), OUTPUT_CHUNK_ROWS):
                    yield out.iloc[i:i + OUTPUT_CHUNK_ROWS]

    def close(self) -> None:
        pass


ASOF_OUTPUT = StructType([
    StructField("customer_id", LongType()), StructField("trade_ts", TimestampType()),
    StructField("trade_info", StringType()), StructField("customer_ts", TimestampType()),
    StructField("customer_info", StringType())])

_RECORD = StructType([StructField("t_us", LongType()), StructField("info", StringType())])


class AsofProcessor(OrderedProcessor):
    """Latest customer record at or before each trade, per customer id.

    Trades and records wait in the reorder buffer (records first at equal times, of several
    the greatest info last); once released, only the latest record stays in state."""

    ORDER = ["t_us", "side", "info"]

    def start(self, handle):
        self.latest = handle.getValueState("latest", _RECORD)

    def released(self, key, rows):
        before = self.latest.get() if self.latest.exists() else (None, None)
        record = rows["side"] == 0
        # the place of the last record so far; -1 is the one from state
        at = pd.Series(np.where(record, np.arange(len(rows)), -1)).cummax().to_numpy()
        if at[-1] >= 0:
            last = rows.iloc[at[-1]]
            self.latest.update((int(last["t_us"]), last["info"]))
        trades = np.flatnonzero(~record.to_numpy())
        if not len(trades):
            return None
        of, t, info = at[trades], rows["t_us"].tolist(), rows["info"].tolist()
        return pd.DataFrame({
            "customer_id": pd.Series([key[0]] * len(trades), dtype="Int64"),
            "trade_ts": timestamps([t[i] for i in trades]),
            "trade_info": [info[i] for i in trades],
            "customer_ts": timestamps([t[i] if i >= 0 else before[0] for i in of]),
            "customer_info": [info[i] if i >= 0 else before[1] for i in of]})


RIDE_ORDER_OUTPUT = StructType([
    StructField("driver_id", LongType()), StructField("ride_id", LongType()),
    StructField("is_start", BooleanType()), StructField("event_time", TimestampType()),
    StructField("seq", LongType())])


class RideOrderProcessor(OrderedProcessor):
    """Position of each ride record in its driver's order (event time, START first, id)."""

    ORDER = ["t_us", "end", "ride_id"]

    def start(self, handle):
        self.last = handle.getValueState("position", _PARTS)

    def released(self, key, rows):
        before = self.last.get()[0] if self.last.exists() else 0
        self.last.update((before + len(rows),))
        return pd.DataFrame({
            "driver_id": pd.Series([key[0]] * len(rows), dtype="Int64"),
            "ride_id": rows["ride_id"], "is_start": rows["end"] == 0,
            "event_time": timestamps(rows["t_us"]),
            "seq": np.arange(before + 1, before + 1 + len(rows))})


class Stats:
    """Length, first instant, top speed and throttle spread of a growing segment."""

    FIELDS = StructType([StructField("rows", LongType()), StructField("first", LongType()),
                         StructField("last", LongType()), StructField("speed", DoubleType()),
                         StructField("n", LongType()), StructField("mean", DoubleType()),
                         StructField("dev", DoubleType())])

    def __init__(self, rows=0, first=None, last=None, speed=None, n=0, mean=0.0, dev=0.0):
        self.rows, self.first, self.last, self.speed = rows, first, last, speed
        self.n, self.mean, self.dev = n, mean, dev

    def tuple(self) -> tuple:
        return (self.rows, self.first, self.last, self.speed, self.n, self.mean, self.dev)

    def merge(self, o: "Stats") -> "Stats":
        """Both together; squared deviations move by n * m / (n + m) * (difference of means)^2."""
        if not self.rows or not o.rows:
            return o if o.rows else self
        n = self.n + o.n
        mean, dev = self.mean, self.dev
        if o.n:
            mean = self.mean + (o.mean - self.mean) * o.n / n if self.n else o.mean
            dev = self.dev + o.dev + ((o.mean - self.mean) ** 2 * self.n * o.n / n if self.n else 0)
        speeds = [x for x in (self.speed, o.speed) if x is not None]
        return Stats(self.rows + o.rows, min(self.first, o.first), max(self.last, o.last),
                     max(speeds) if speeds else None, n, mean, dev)

    @classmethod
    def of(cls, rows: pd.DataFrame) -> "Stats":
        throttle = rows["throttle"].dropna().to_numpy(np.float64)
        speed = rows["speed"].dropna()
        mean = float(throttle.mean()) if len(throttle) else 0.0
        return cls(len(rows), int(rows["t_us"].iloc[0]), int(rows["t_us"].iloc[-1]),
                   float(speed.max()) if len(speed) else None, len(throttle), mean,
                   float(((throttle - mean) ** 2).sum()))

    def output(self, key: tuple) -> tuple:
        whole = None if self.speed is None or not abs(self.speed) < 2 ** 31 else int(self.speed)
        return (key[0], self.first, self.rows, whole, (self.dev / self.n) ** 0.5 if self.n else None)


def segment_output(key_type) -> StructType:
    return StructType([StructField("key", key_type), StructField("start_time", TimestampType()),
                       StructField("length", LongType()), StructField("max_speed", IntegerType()),
                       StructField("erraticness", DoubleType())])


def _segments(found: list[tuple]) -> pd.DataFrame | None:
    if not found:
        return None
    key, first, rows, speed, erratic = zip(*found)
    return pd.DataFrame({"key": list(key), "start_time": timestamps(list(first)),
                         "length": list(rows), "max_speed": pd.Series(speed, dtype="Int32"),
                         "erraticness": pd.Series(erratic, dtype="float64")})


class StoppedSegmentProcessor(OrderedProcessor):
    """Segments between stops.  A stop closes the open segment; the segment after the last
    stop stays open in state.  Events at the time of a stop belong to no segment."""

    ORDER = ["t_us", "moving"]

    def start(self, handle):
        self.open = handle.getValueState("open", Stats.FIELDS)
        self.stopped = handle.getValueState("stopped", _BUCKET)

    def released(self, key, rows):
        open_ = Stats(*self.open.get()) if self.open.exists() else Stats()
        last_stop = self.stopped.get()[0] if self.stopped.exists() else None
        found = []
        stops = rows["t_us"].where(rows["moving"] == 0)
        # the segment of a moving event starts at the last stop before it in the order
        stop_before = stops.ffill()
        at_stop = rows["t_us"] == stop_before.fillna(-1 if last_stop is None else last_stop)
        moving = rows[(rows["moving"] == 1) & ~at_stop]
        number = (rows["moving"] == 0).cumsum()
        parts = {n: Stats.of(part) for n, part in moving.groupby(number[moving.index], sort=True)}
        for n in range(int(number.iloc[-1]) + 1):
            if n and open_.rows:        # stop n closes what was open
                found.append(open_.output(key))
            open_ = open_.merge(parts.get(n, Stats())) if not n else parts.get(n, Stats())
        if stop_before.notna().any():
            self.stopped.update((int(stop_before.iloc[-1]),))
        if open_.rows:
            self.open.update(open_.tuple())
        else:
            self.open.clear()
        return _segments(found)


class GapSegmentProcessor(StatefulProcessor):
    """Merges bucket partials of a key into segments that end after a gap.

    Partials come one gap wide and, after an append-mode aggregate, in time order over the
    batches; those of one batch are sorted here.  State is the open segment alone."""

    def __init__(self, gap_us: int) -> None:
        self.gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", Stats.FIELDS)

    def _timer(self, last_us: int) -> None:
        # an event up to a gap later may still be in a bucket that ends another gap later
        self.handle.registerTimer(-(-(last_us + 2 * self.gap) // 1000) + 1)

    def handleInputRows(self, key, rows, timerValues):
        open_ = Stats(*self.open.get()) if self.open.exists() else None
        found = []
        parts = pd.concat(list(rows), ignore_index=True).sort_values("first_us")  # one a bucket
        for p in parts.itertuples(index=False):
            part = Stats(int(p.rows), int(p.first_us), int(p.last_us),
                         None if pd.isna(p.speed) else float(p.speed), int(p.n),
                         0.0 if pd.isna(p.mean) else float(p.mean),
                         0.0 if pd.isna(p.dev) else float(p.dev))
            if open_ is not None and part.first - open_.last > self.gap:
                found.append(open_.output(key))
                open_ = None
            open_ = part if open_ is None else open_.merge(part)
        if open_ is not None:
            self.open.update(open_.tuple())
            self._timer(open_.last)
        out = _segments(found)
        if out is not None:
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.open.exists():
            open_ = Stats(*self.open.get())
            if open_.last + 2 * self.gap <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
                self.open.clear()
                yield _segments([open_.output(key)])

    def close(self) -> None:
        pass


PREDICTION_OUTPUT = StructType([
    StructField("bucket", IntegerType()), StructField("ride_id", LongType()),
    StructField("end_time", TimestampType()), StructField("samples_before", LongType()),
    StructField("predicted", IntegerType())])

_SUMS = StructType([StructField("n", LongType()), StructField("sxy", StringType()),
                    StructField("sxx", StringType())])
#: sums are whole numbers of this part of one, so that no order or split of the rows counts
UNIT = 10 ** 18


class PredictionProcessor(OrderedProcessor):
    """Predicts each finished ride from the rides of its direction that finished before it, then
    adds it.  State is a count and two exact sums; ``min_points`` and ``min_sxx`` as in the
    batch model."""

    ORDER = ["t_us", "ride_id"]

    def __init__(self, min_points: int, min_sxx: float, bucket_seconds: float = BUCKET_SECONDS):
        super().__init__(bucket_seconds)
        self.min_points, self.min_sxx = min_points, min_sxx

    def start(self, handle):
        self.sums = handle.getValueState("sums", _SUMS)

    def released(self, key, rows):
        n, sxy, sxx = self.sums.get() if self.sums.exists() else (0, "0", "0")
        sxy, sxx = int(sxy), int(sxx)
        predicted = []
        for x, xy, xx in zip(rows["distance"], rows["xy"], rows["xx"]):
            value, total = None, sxx / UNIT
            if n + len(predicted) >= self.min_points and total >= self.min_sxx and x == x:
                value = sxy / UNIT / total * x
            fits = value is not None and value == value and abs(value) < 2 ** 31
            predicted.append(int(value) if fits else -1)
            sxy += int(xy) if xy is not None else 0
            sxx += int(xx) if xx is not None else 0
        out = pd.DataFrame({
            "bucket": pd.Series([key[0]] * len(rows), dtype="Int32"), "ride_id": rows["ride_id"],
            "end_time": timestamps(rows["t_us"]),
            "samples_before": np.arange(n, n + len(rows)), "predicted": predicted})
        self.sums.update((n + len(rows), str(sxy), str(sxx)))
        return out

"""Stateful processors driven directly through a minimal in-memory state handle."""

import numpy as np
import pandas as pd

from cabline.streaming import ordered
from cabline.streaming.ordered import AsofProcessor, StoppedSegmentProcessor


class _Value:
    def __init__(self):
        self.item = None

    def exists(self):
        return self.item is not None

    def get(self):
        return self.item

    def update(self, item):
        self.item = item

    def clear(self):
        self.item = None


class _Map:
    def __init__(self):
        self.items, self.read = {}, []

    def containsKey(self, key):
        return key in self.items

    def getValue(self, key):
        self.read.append(key)
        return self.items[key]

    def updateValue(self, key, value):
        self.items[key] = value

    def removeKey(self, key):
        del self.items[key]

    def keys(self):
        return iter(list(self.items))


class _Handle:
    def __init__(self):
        self.states = {}
        self.timers = set()

    def getValueState(self, name, schema):
        return self.states.setdefault(name, _Value())

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, _Map())

    def registerTimer(self, ms):
        self.timers.add(ms)


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def _rows(side, times_ms, infos):
    t = np.array(times_ms, np.int64) * 1000
    return [pd.DataFrame({"customer_id": 0, "side": side, "ts": pd.to_datetime(t, unit="us"),
                          "info": infos, "t_us": t})]


def _started(bucket_seconds=0.1):
    p, h = AsofProcessor(bucket_seconds), _Handle()
    p.init(h)
    return p, h


def _fire(p, ms):
    return [r for f in p.handleExpiredTimer((0,), _Watermark(ms), _Watermark(ms))
            for r in f.to_dict("records")]


def test_customer_only_key_keeps_one_record():
    p, h = _started()
    list(p.handleInputRows((0,), iter(_rows(0, [100, 200, 300], ["a", "b", "c"])), None))
    assert h.timers == {200, 300, 400}       # the ends of the buckets in use
    assert _fire(p, 300) == []
    assert h.states["latest"].item == (200_000, "b")
    assert list(h.states["waiting_parts"].items) == [(3,)]
    _fire(p, 400)
    assert h.states["latest"].item == (300_000, "c")
    assert not h.states["waiting_rows"].items and not h.states["waiting_parts"].items


def test_trades_get_latest_customer_at_or_before():
    p, h = _started()
    list(p.handleInputRows((0,), iter(_rows(0, [0, 500, 1500, 1600, 2100],
                                            ["@0", "@500", "@1500", "@1600", "@2100"])), None))
    list(p.handleInputRows((0,), iter(_rows(1, [1000, 1200, 1500, 1700, 1800, 2000],
                                            ["t1", "t2", "t3", "t4", "t5", "t6"])), None))
    got = {r["trade_info"]: r["customer_info"] for r in _fire(p, 2100)}
    assert got == {"t1": "@500", "t2": "@500", "t3": "@1500", "t4": "@1600", "t5": "@1600",
                   "t6": "@1600"}
    assert list(h.states["waiting_parts"].items) == [(21,)]
    assert h.states["latest"].item == (1_600_000, "@1600")


def test_rows_arrive_in_several_chunks_and_batches():
    p, h = _started()
    chunks = _rows(1, [450, 900], ["t1", "t2"]) + _rows(0, [0, 500], ["@0", "@500"])
    list(p.handleInputRows((0,), iter(chunks), None))
    assert _fire(p, 500) == [{"customer_id": 0, "trade_ts": pd.Timestamp(450 * 10**6),
                              "trade_info": "t1", "customer_ts": pd.Timestamp(0),
                              "customer_info": "@0"}]
    assert [(r["trade_info"], r["customer_info"]) for r in _fire(p, 1000)] == [("t2", "@500")]
    list(p.handleInputRows((0,), iter(_rows(1, [1100], ["t3"])), None))
    assert [(r["trade_info"], r["customer_info"]) for r in _fire(p, 1300)] == [("t3", "@500")]


def test_a_timer_reads_the_due_buckets_only():
    p, h = _started(1)
    list(p.handleInputRows((0,), iter(_rows(1, [i * 1000 for i in range(500)],
                                            [str(i) for i in range(500)])), None))
    rows = h.states["waiting_rows"]
    rows.read.clear()
    assert len(_fire(p, 3000)) == 3
    assert rows.read == [(0, 0), (1, 0), (2, 0)] and len(rows.items) == 497


def test_released_trades_leave_in_chunks(monkeypatch):
    monkeypatch.setattr(ordered, "OUTPUT_CHUNK_ROWS", 2)
    p, h = _started(1)
    list(p.handleInputRows((0,), iter(_rows(0, [0], ["@0"]) + _rows(1, [1, 2, 3, 4, 5],
                                                                      list("abcde"))), None))
    frames = list(p.handleExpiredTimer((0,), _Watermark(1000), _Watermark(1000)))
    assert [len(f) for f in frames] == [2, 2, 1]
    assert sorted(r for f in frames for r in f["trade_info"]) == list("abcde")


def test_open_segment_goes_on_over_releases():
    p, h = StoppedSegmentProcessor(1), _Handle()
    p.init(h)

    def add(*rows):
        t, moving, speed, throttle = zip(*rows)
        list(p.handleInputRows((1,), iter([pd.DataFrame({
            "t_us": np.array(t, np.int64) * 1000, "moving": moving, "speed": speed,
            "throttle": throttle})]), None))

    def fire(ms):
        return [(r["length"], r["max_speed"], r["erraticness"]) for r in
                (x for f in p.handleExpiredTimer((1,), _Watermark(ms), _Watermark(ms))
                 for x in f.to_dict("records"))]

    add((100, 1, 5.0, 1.0), (1500, 1, 9.5, 3.0), (1200, 0, 0.0, 0.0), (1200, 1, 99.0, 9.0),
        (2500, 0, 0.0, 0.0), (2600, 1, None, None))
    assert fire(1000) == []
    assert fire(2000) == [(1, 5, 0.0)]          # the event at the time of the stop is in none
    assert fire(3000) == [(1, 9, 0.0)]
    add((3100, 1, 4.0, 2.0), (3200, 0, 0.0, 0.0))
    assert fire(4000) == [(2, 4, 0.0)]
    assert not h.states["open"].exists() and h.states["stopped"].item == (3_200_000,)

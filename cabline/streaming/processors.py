"""Stateful processors for ``transformWithStateInPandas`` (event-time mode).

State per key is one waiting element per side; timers fire when the watermark
reaches an element's deadline, so state never outlives the watermark.  Processors that
need a key's rows in order are in ``ordered.py``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from cabline._shipping import ship_by_value

# Code in this module runs inside Python workers: ship it with the task, so
# executors need no installed copy of the package.
ship_by_value(__name__)

#: ``ride`` and ``fare`` are whole records as text, as they came in
EXPIRING_OUTPUT = StructType([
    StructField("ride_id", LongType()), StructField("outcome", StringType()),
    StructField("ride_time", TimestampType()), StructField("fare_time", TimestampType()),
    StructField("ride", StringType()), StructField("fare", StringType())])

_WAITING = StructType([StructField("t_us", LongType()), StructField("record", StringType())])


def _ts(us: int | None):
    return None if us is None else pd.Timestamp(int(us) * 1000)


def _ceil_ms(us: int) -> int:
    return -((-int(us)) // 1000)


class ExpiringPairProcessor(StatefulProcessor):
    """Pair a ride and a fare with the same id; expire whatever waits too long.

    A waiting element registers a timer at its event time + ``max_wait``.
    When that timer fires, the element still waiting (checked by its own time,
    since timers are never cancelled) goes out as unmatched.  Rows are
    ``(side 'R' or 'F', t_us, record)``.
    """

    def __init__(self, max_wait_seconds: int = 0):
        self.max_wait_us = int(max_wait_seconds) * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = {side: handle.getValueState(name, _WAITING)
                        for side, name in (("R", "ride"), ("F", "fare"))}

    def _row(self, key, outcome, ride, fare) -> tuple:
        return (key[0], outcome, _ts(ride and ride[0]), _ts(fare and fare[0]),
                ride and ride[1], fare and fare[1])

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=EXPIRING_OUTPUT.names)

    def handleInputRows(self, key, rows, timerValues):
        out = []
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["t_us", "side"], kind="stable")
        for side, t_us, record in zip(batch["side"], batch["t_us"].tolist(), batch["record"]):
            own, other = (self.waiting[x] for x in (side, "F" if side == "R" else "R"))
            partner = other.get() if other.exists() else None
            if partner is not None and abs(partner[0] - t_us) <= self.max_wait_us:
                pair = ((t_us, record), partner)
                out.append(self._row(key, "matched", *(pair if side == "R" else pair[::-1])))
                other.clear()
            else:
                own.update((t_us, record))
                self.handle.registerTimer(_ceil_ms(t_us + self.max_wait_us))
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        deadline_us = expiredTimerInfo.getExpiryTimeInMs() * 1000
        out = []
        for side, outcome in (("R", "unmatched_ride"), ("F", "unmatched_fare")):
            state = self.waiting[side]
            if state.exists() and state.get()[0] + self.max_wait_us <= deadline_us:
                found = state.get()
                out.append(self._row(key, outcome, *((found, None) if side == "R" else (None, found))))
                state.clear()
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass

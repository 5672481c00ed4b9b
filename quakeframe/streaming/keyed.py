"""What the stateful operators share: a small state per key, worked off in the order of event time.

A key's state is one JSON text in RocksDB. Operators keep it small by what they put there: one entry
per evaluation step, open run or member, however many events a key has.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

_TEXT = StructType([StructField("text", StringType())])


def delay_millis(spark: SparkSession, delay: str | None) -> int | None:
    """A watermark's delay (an interval of days or less) in milliseconds."""
    if delay is None:
        return None
    return spark.sql(f"SELECT unix_millis(timestamp_millis(0) + interval {delay.lower().removeprefix('interval')}) AS ms").first()["ms"]


class Ordered(StatefulProcessor):
    """Takes what comes in, then works off all changes up to the watermark, then waits for the next one.

    Subclasses say what a state is (``empty``), how rows enter it (``take``), when something happens next
    (``next_at``) and what happens then (``step``, which returns output rows). All times are milliseconds.
    Rows of a micro-batch enter before anything is worked off, and Spark drops rows that the watermark
    has passed, so an instant is worked off once everything up to it is known.

    The rows of a key come in many parts. An operator that knows by how much the watermark stays behind (``delay``)
    knows from the latest row how far the next watermark is at least, and need not keep what cannot matter there.
    """

    columns: list[str] = []
    queues: list[str] = []  # entries of a state from whose ends things are taken

    def empty(self) -> dict:
        raise NotImplementedError

    def take(self, key: tuple, state: dict, rows: pd.DataFrame) -> list[tuple]:
        """Adds rows to the state; what it returns is put out at once."""
        raise NotImplementedError

    def taken(self, key: tuple, state: dict) -> None:
        """Once all rows of a micro-batch are in the state."""

    def next_at(self, key: tuple, state: dict) -> int | None:
        raise NotImplementedError

    def step(self, key: tuple, state: dict, at: int) -> list[tuple]:
        raise NotImplementedError

    def settle(self, key: tuple, state: dict) -> list[tuple]:
        """What is put out once all is worked off that the watermark allows."""
        return []

    def idle(self, state: dict) -> bool:
        """Whether the state can be forgotten once nothing is to come."""
        return True

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _TEXT)

    def clock(self, timer_values) -> int:
        return timer_values.getCurrentWatermarkInMs()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._load()
        self.now = self.clock(timerValues)
        out = [row for part in rows for row in self.take(key, state, part)]
        self.taken(key, state)
        yield self._advanced(key, state, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        state = self._load()
        self.now = self.clock(timerValues)
        if state["timer"] is not None and state["timer"] <= expiredTimerInfo.getExpiryTimeInMs():
            state["timer"] = None  # Spark has removed it
        yield self._advanced(key, state, [])

    def close(self) -> None:
        pass

    def _load(self) -> dict:
        state = json.loads(self.state.get()[0]) if self.state.exists() else {**self.empty(), "timer": None}
        return {**state, **{name: deque(state[name]) for name in self.queues}}

    def _advanced(self, key: tuple, state: dict, out: list[tuple]) -> pd.DataFrame:
        at = self.next_at(key, state)
        while at is not None and at <= self.now:
            out += self.step(key, state, at)
            at = self.next_at(key, state)
        out += self.settle(key, state)
        if state["timer"] not in (None, at):
            self.handle.deleteTimer(state["timer"])
        if at is not None and state["timer"] != at:
            self.handle.registerTimer(at)
        state["timer"] = at
        if at is None and self.idle(state):
            self.state.clear()
        else:
            self.state.update((json.dumps(state, default=list),))
        return pd.DataFrame([(*key, *row) for row in out], columns=self.columns)

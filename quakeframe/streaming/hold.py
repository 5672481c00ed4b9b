"""Hold time of alert rules on a stream.

The batch form is ``operators.alerts.sustained``. Here each (rule, labels) key keeps its current run
as state: where it began, the last instant seen and whether it has fired. An event-time timer one
step after the last instant resolves the run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from quakeframe.operators.statistics import sliding

_RUN = StructType([
    StructField("start", LongType()), StructField("last", LongType()), StructField("fired", BooleanType()),
])


class _Hold(StatefulProcessor):
    """Times are milliseconds, as those of the timers."""

    def __init__(self, keys: Sequence[str], hold: int, step: int) -> None:
        self.keys, self.hold, self.step = list(keys), hold, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", _RUN)

    def _frame(self, key, changes: list[tuple[str, int]]) -> pd.DataFrame:
        rows = [(*key, state, pd.Timestamp(at, unit="ms")) for state, at in changes]
        return pd.DataFrame(rows, columns=[*self.keys, "state", "at"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = sorted({int(t) for part in rows for t in part["tick_ms"]})
        start, last, fired = self.run.get() if self.run.exists() else (None, None, False)
        changes: list[tuple[str, int]] = []
        for tick in seen:
            if last is not None and tick <= last:
                continue
            if last is None or tick - last > self.step:
                if last is not None:
                    changes.append(("resolved" if fired else "cleared", last + self.step))
                start, fired = tick, False
                changes.append(("pending", tick))
            last = tick
            if not fired and tick - start >= self.hold:
                fired = True
                changes.append(("firing", start + self.hold))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last + self.step)
        self.run.update((start, last, fired))
        yield self._frame(key, changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.run.exists():
            return
        _, last, fired = self.run.get()
        self.run.clear()
        yield self._frame(key, [("resolved" if fired else "cleared", last + self.step)])

    def close(self) -> None:
        pass


def _changes(rows: DataFrame, keys: Sequence[str], hold_seconds: int, step_seconds: int) -> DataFrame:
    schema = ", ".join([*[f"{k} string" for k in keys], "state string", "at timestamp"])
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Hold(keys, hold_seconds * 1000, step_seconds * 1000),
        outputStructType=schema, outputMode="append", timeMode="EventTime",
    )


def hold_stream(
    ticks: DataFrame, keys: Sequence[str], hold_seconds: int, step_seconds: int = 15, delay: str = "0 seconds",
) -> DataFrame:
    """Changes of state (pending, firing, resolved, or cleared before firing) per key.

    ``ticks`` is a stream with a row per key and instant (``tick``) at which the condition is
    true. Needs the RocksDB state store.
    """
    labels = [F.col(k).cast("string").alias(k) for k in keys]
    rows = ticks.withWatermark("tick", delay).select(*labels, "tick", F.unix_millis("tick").alias("tick_ms"))
    return _changes(rows, keys, hold_seconds, step_seconds)


def count_rule_stream(
    silver: DataFrame, at_least: int = 3, hold_seconds: int = 120, lookback_seconds: int = 300, step_seconds: int = 15,
) -> DataFrame:
    """A count rule on silver events: sliding counts, then the hold time, in one query.

    The instants are the ends of the windows, so an event is seen from the first instant after it.
    """
    counts = sliding(silver, ["region"], lookback_seconds, step_seconds, measured=False)
    held = counts.where(F.col("eq_count") >= at_least).select(
        "region", F.unix_millis("window_end").alias("tick_ms")
    )
    return _changes(held, ["region"], hold_seconds, step_seconds)

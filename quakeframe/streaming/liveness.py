"""Status panels kept by a stream: a row per panel and calendar unit, also for units in which nothing came.

The batch form is ``operators.panels.source_liveness``, which reads the range of the panels anew each time.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.functions import bins
from quakeframe.operators import panels
from quakeframe.streaming.keyed import Ordered, delay_millis

UNITS = "panel string, part int, bucket_ms bigint, last_us bigint"
PARTS = 16  # into which the points of a panel are dealt, by their times
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _start(moment: datetime, unit: str) -> datetime:
    """The beginning of the calendar unit (UTC) of an instant."""
    day = moment.replace(hour=0, minute=0, second=0, microsecond=0)
    return day if unit == "day" else day.replace(day=1) if unit == "month" else day.replace(month=1, day=1)


def _next(start: datetime, unit: str) -> datetime:
    return _start(start + timedelta({"day": 1, "month": 31, "year": 366}[unit]), unit)


def _back(moment: datetime, months: int = 0, **rest: int) -> datetime:
    """An instant some months (its day cut to the length of the month) or some days, hours, ... before."""
    if not months:
        return moment - timedelta(**rest)
    year, month = divmod(moment.year * 12 + moment.month - 1 - months, 12)
    longest = (_next(datetime(year, month + 1, 1, tzinfo=timezone.utc), "month") - timedelta(1)).day
    return moment.replace(year=year, month=month + 1, day=min(moment.day, longest))


def _millis(moment: datetime) -> int:
    return (moment - _EPOCH) // timedelta(milliseconds=1)


def _moment(millis: int) -> datetime:
    return _EPOCH + timedelta(milliseconds=millis)


class _Units(Ordered):
    """Of one part of a panel: its calendar units from the beginning of its range on, and when something last came in each.

    ``waiting`` has the times (microseconds) that the watermark has not reached, ``next`` the end of the last
    unit. A timer at that end adds the next unit, empty; units that have left the range are forgotten. With a
    ``delay``, of the times that the next watermark will have passed only the first and the last of each unit wait.
    """

    columns = ["panel", "part", "bucket_ms", "last_us"]

    def __init__(self, ranges: dict[str, tuple[str, dict]], delay: int | None = None) -> None:
        self.ranges, self.delay = ranges, delay

    def empty(self) -> dict:
        return {"waiting": [], "units": {}, "next": None, "changed": []}

    def take(self, key, state, rows: pd.DataFrame) -> list[tuple]:
        times = np.unique(np.concatenate([np.asarray(state["waiting"], "i8"), rows["time_us"].to_numpy("i8")]))
        if self.delay is not None and len(times):
            until = (times[-1] // 1000 - self.delay) * 1000
            unit = times.astype("M8[us]").astype({"day": "M8[D]", "month": "M8[M]", "year": "M8[Y]"}[self.ranges[key[0]][0]])
            last = np.append(unit[1:] != unit[:-1], True) | np.append(times[1:] > until, True)
            first = np.append(True, times[:-1] <= self.now * 1000)  # those up to now are worked off at once
            times = times[last | first | (times <= self.now * 1000) | (times > until)]
        state["waiting"] = times
        return []

    def next_at(self, key, state) -> int | None:
        times = [-(-int(state["waiting"][0]) // 1000)] if len(state["waiting"]) else []
        return min(times + ([state["next"]] if state["next"] is not None else []), default=None)

    def step(self, key, state, at) -> list[tuple]:
        unit, back = self.ranges[key[0]]
        if state["next"] is None:  # from the first event on, with the range before it
            start = _start(_back(_moment(at), **back), unit)
            while start <= _moment(at):
                self._put(state, start, None)
                start = _next(start, unit)
            state["next"] = _millis(start)
        elif at >= state["next"]:
            start = _moment(state["next"])
            self._put(state, start, None)
            state["next"] = _millis(_next(start, unit))
            oldest = _millis(_start(_back(start, **back), unit))
            state["units"] = {b: last for b, last in state["units"].items() if int(b) >= oldest}
        until = min(self.now, state["next"] - 1)
        passed = int(np.searchsorted(state["waiting"], until * 1000, side="right"))
        for last in map(int, state["waiting"][:passed]):
            self._put(state, _start(_EPOCH + timedelta(microseconds=last), unit), last)
        state["waiting"] = state["waiting"][passed:]
        return []

    def _put(self, state: dict, start: datetime, last: int | None) -> None:
        bucket = str(_millis(start))
        if last is not None or bucket not in state["units"]:
            known = state["units"].get(bucket)
            state["units"][bucket] = last if known is None else max(known, last)
            if bucket not in state["changed"]:
                state["changed"].append(bucket)

    def settle(self, key, state) -> list[tuple]:
        out = [(int(b), state["units"][b]) for b in state["changed"] if b in state["units"]]
        state["changed"], state["waiting"] = [], np.asarray(state["waiting"], "i8").tolist()
        return out

    def idle(self, state) -> bool:
        return False


def unit_stream(points: DataFrame, status_panels=panels.LIVENESS, delay: str | None = None) -> DataFrame:
    """When something last came, for each part of a panel and calendar unit; null for a unit in which nothing has.

    ``points`` has a watermark on ``time``. With its ``delay`` (or a longer one) the state of a part is bounded by its
    units and what the delay holds, however much comes in a micro-batch; without, it also has all that the watermark
    has not reached. To be kept by ``gauges.write_series`` with the keys ``panel`` and ``bucket_ms``. Needs the
    RocksDB state store and update mode.
    """
    named = [F.lit(panel) if source is None else F.when(F.col("source") == source, panel) for panel, source, _, _ in status_panels]
    rows = points.select("time", F.unix_micros("time").alias("time_us"), F.explode(F.array(*named)).alias("panel")).where("panel is not null")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("time"), F.lit(PARTS)).cast("int"))
    ranges = {panel: (unit, back) for panel, _, unit, back in status_panels}
    return rows.groupBy("panel", "part").transformWithStateInPandas(
        statefulProcessor=_Units(ranges, delay_millis(points.sparkSession, delay)), outputStructType=UNITS, outputMode="update", timeMode="EventTime")


def status(units: DataFrame, as_of: Column, status_panels=panels.LIVENESS) -> DataFrame:
    """``panel, bucket, flag, status`` at an instant, from the kept units: those of the batch form.

    A unit counts only what came within the panel's range, which begins in the midst of its first unit.
    """
    units = units.groupBy("panel", "bucket_ms").agg(F.max("last_us").alias("last_us"))
    bucket, flag = F.timestamp_millis("bucket_ms"), F.lit(None).cast("int")
    shown, text = F.lit(False), F.lit(None).cast("string")
    for panel, _, unit, back in status_panels:
        start = as_of - F.make_ym_interval(months=F.lit(back["months"])) if "months" in back else as_of - F.make_dt_interval(**{k: F.lit(v) for k, v in back.items()})
        own = F.col("panel") == panel
        came = F.when(F.timestamp_micros("last_us") >= start, 1).otherwise(0)
        flag = F.when(own, came).otherwise(flag)
        text = F.when(own, bins.flag_text(came, panel)).otherwise(text)
        shown = shown | own & (bucket >= F.date_trunc(unit, start)) & (bucket <= F.date_trunc(unit, as_of))
    return units.where(shown).select("panel", bucket.alias("bucket"), flag.alias("flag"), text.alias("status"))

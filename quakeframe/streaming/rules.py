"""Alert rules on streams: look-backs with their hold times, and silences.

The batch forms are ``operators.metrics`` (timelines), ``operators.alerts.firing`` and ``data_gaps``.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.operators import alerts, metrics
from quakeframe.streaming.keyed import Ordered

DAY_MS = 86_400_000


@dataclass(frozen=True)
class Watch:
    """A rule over the last ``lookback_seconds`` of a region: the strongest event (from ``above`` on), or the number of events."""

    rule: alerts.Rule
    lookback_seconds: int = 300
    above: float | None = None  # strongest event, labelled by its depth
    at_least: int | None = None  # number of events
    hold_seconds: int | None = None  # of the rule, if not given

    @property
    def hold_ms(self) -> int:
        return 1000 * (self.rule.hold_seconds if self.hold_seconds is None else self.hold_seconds)


# Thresholds and look-backs of the rules over events.
WATCHES = (
    Watch(alerts.RULES["HighMagnitudeEarthquake"], above=6.0), Watch(alerts.RULES["CriticalMagnitudeEarthquake"], above=7.0),
    Watch(alerts.RULES["EarthquakeSwarmDetected"], at_least=3), Watch(alerts.RULES["RegionalSeismicActivity"], 3600, at_least=11),
)

CHANGES = ("alertname string, region string, severity string, depth_bin string, state string, at_ms bigint, "
           "pending_ms bigint, firing_ms bigint, peak double")


class _LookBack(Ordered):
    """The sliding maximum with its label, or the sliding count, of one rule and region, and its current run.

    ``waiting`` has an entry per instant at which events are first seen: [first, gone, number, best].
    ``seen`` is a queue of those in the look-back. For a maximum it is monotone: an entry that comes in
    drives out the weaker ones before it, which leave earlier, so the head is the strongest. For a count
    nothing is driven out and ``value`` is kept beside it. Both have one entry per step at most, twice
    where events lie on an instant.
    """

    columns = ["alertname", "region", "severity", "depth_bin", "state", "at_ms", "pending_ms", "firing_ms", "peak"]
    queues = ["waiting", "seen"]

    def __init__(self, watches: dict[str, Watch]) -> None:
        self.watches = watches

    def empty(self) -> dict:
        return {"waiting": [], "seen": [], "value": 0, "run": None}

    def take(self, key, state, rows: pd.DataFrame) -> list[tuple]:
        if not isinstance(state["waiting"], dict):
            state["waiting"] = {(first, gone): [n, best] for first, gone, n, best in state["waiting"]}
        waiting = state["waiting"]
        best = rows.sort_values(["magnitude", "time_us", "event_id"]).groupby(["first_ms", "gone_ms"]).agg(
            n=("magnitude", "size"), magnitude=("magnitude", "last"), time_us=("time_us", "last"),
            event_id=("event_id", "last"), depth_bin=("depth_bin", "last"))
        for row in best.itertuples():
            own = [float(row.magnitude), int(row.time_us), row.event_id, row.depth_bin]
            n, other = waiting.get(row.Index, (0, own))
            waiting[tuple(map(int, row.Index))] = [n + int(row.n), max(own, other)]
        return []

    def taken(self, key, state) -> None:
        if isinstance(state["waiting"], dict):
            state["waiting"] = deque([*at, *entry] for at, entry in sorted(state["waiting"].items()))

    def next_at(self, key, state) -> int | None:
        run, hold = state["run"], self.watches[key[0]].hold_ms
        times = [queue[0][i] for queue, i in ((state["waiting"], 0), (state["seen"], 1)) if queue]
        if run and run["fired"] is None:
            times.append(run["start"] + hold)
        return min(times, default=None)

    def step(self, key, state, at) -> list[tuple]:
        watch, seen = self.watches[key[0]], state["seen"]
        while seen and seen[0][1] <= at:
            state["value"] -= seen.popleft()[2]
        while state["waiting"] and state["waiting"][0][0] <= at:
            entry = state["waiting"].popleft()
            if watch.above is not None:
                while seen and seen[-1][3][:3] < entry[3][:3]:
                    state["value"] -= seen.pop()[2]
            seen.append(entry)
            state["value"] += entry[2]
        if watch.above is not None:
            holds, label, value = bool(seen), seen[0][3][3] if seen else None, seen[0][3][0] if seen else None
        else:
            holds, label, value = state["value"] >= watch.at_least, None, state["value"]
        return self._run(key, state, watch, at, holds, label, value)

    def _run(self, key, state, watch, at, holds, label, value) -> list[tuple]:
        run, out = state["run"], []

        def put(name: str) -> None:
            out.append((watch.rule.severity, run["label"], name, at, run["start"], run["fired"], float(run["peak"])))

        if run and not (holds and label == run["label"]):
            put("cleared" if run["fired"] is None else "resolved")
            run = None
        if holds:
            if run is None:
                run = {"label": label, "start": at, "peak": value, "fired": None}
                if watch.hold_ms:
                    put("pending")
            run["peak"] = max(run["peak"], value)
            if run["fired"] is None and at >= run["start"] + watch.hold_ms:
                run["fired"] = at
                put("firing")
        state["run"] = run
        return out


def rule_stream(points: DataFrame, watches: tuple[Watch, ...] = WATCHES, step_seconds: int = alerts.STEP_SECONDS) -> DataFrame:
    """Changes of state (pending, firing, resolved, or cleared before firing) of all rules over event points.

    ``points`` is a stream with a watermark on ``time``. ``resolved`` and ``cleared`` rows have the whole
    run: its first instant, when it fired and its peak. Equal to the alerts of the batch form as far as
    the watermark has come. Needs the RocksDB state store.
    """
    each = []
    for watch in watches:
        first, gone = metrics._seen(F.col("time"), watch.lookback_seconds, step_seconds)
        entry = F.struct(F.lit(watch.rule.name).alias("alertname"), (first / 1000).cast("bigint").alias("first_ms"), (gone / 1000).cast("bigint").alias("gone_ms"))
        each.append(entry if watch.above is None else F.when(F.col("magnitude") > watch.above, entry))
    rows = points.select("region", "depth_bin", "magnitude", "time", F.unix_micros("time").alias("time_us"), "event_id", F.explode(F.array(*each)).alias("w"))
    rows = rows.where("w is not null").select("w.*", "region", "depth_bin", "magnitude", "time", "time_us", "event_id")
    return rows.groupBy("alertname", "region").transformWithStateInPandas(
        statefulProcessor=_LookBack({w.rule.name: w for w in watches}), outputStructType=CHANGES, outputMode="append", timeMode="EventTime")


def closed_alerts(changes: DataFrame, step_seconds: int = alerts.STEP_SECONDS) -> DataFrame:
    """The runs of a change log that fired and are over, with the columns of the batch form."""
    at = lambda c: F.timestamp_millis(c)
    return changes.where("state = 'resolved'").select(
        "region", "depth_bin", at("pending_ms").alias("pending_at"), at("firing_ms").alias("firing_at"), at("at_ms").alias("resolved_at"),
        ((F.col("at_ms") - F.col("pending_ms")) / (1000 * step_seconds)).cast("bigint").alias("ticks"), "peak", "alertname", "severity")


# --- silences ---------------------------------------------------------------------------------

SILENCES = "source string, alertname string, severity string, state string, at_ms bigint, last_ms bigint"


class _Silence(Ordered):
    """Of one source: when something last came, and how far the alarm has got. The clock is that of processing."""

    columns = ["source", "alertname", "severity", "state", "at_ms", "last_ms"]

    def __init__(self, rule: alerts.Rule, limit_ms: int, hold_ms: int) -> None:
        self.rule, self.limit, self.hold = rule, limit_ms, hold_ms

    def empty(self) -> dict:
        return {"last": None, "state": None}

    def clock(self, timer_values) -> int:
        return timer_values.getCurrentProcessingTimeInMs()

    def _row(self, state: dict, name: str, at: int) -> tuple:
        return self.rule.name, self.rule.severity, name, at, state["last"]

    def take(self, key, state, rows) -> list[tuple]:
        if not len(rows):
            return []
        # A timer that is due but has not run yet tells of a silence that these rows end.
        out = []
        while (at := self.next_at(key, state)) is not None and at <= self.now:
            out += self.step(key, state, at)
        if state["state"]:
            out.append(self._row(state, "resolved" if state["state"] == "firing" else "cleared", self.now))
        state["last"], state["state"] = self.now, None
        return out

    def next_at(self, key, state) -> int | None:
        if state["last"] is None or state["state"] == "firing":
            return None
        return state["last"] + self.limit + (self.hold if state["state"] else 0)

    def step(self, key, state, at) -> list[tuple]:
        state["state"] = "firing" if state["state"] else "pending"
        return [self._row(state, state["state"], at)]

    def idle(self, state) -> bool:
        return state["last"] is None


def silence_stream(
    rows: DataFrame, source: str | Column = "source", limit_seconds: float = 300, hold_seconds: float | None = None,
) -> DataFrame:
    """Silences while they last: pending ``limit_seconds`` after the last row of a source, firing when the hold
    time has passed too, resolved (or cleared before firing) by the next row.

    The timers are of processing time and fire without any input. Each row of input arms its source's
    timer anew; a source is known from its first row on and for good.
    """
    rule = alerts.RULES["SeismicDataPipelineDown"]
    hold = rule.hold_seconds if hold_seconds is None else hold_seconds
    keyed = rows.select((F.col(source) if isinstance(source, str) else source).cast("string").alias("source"))
    return keyed.groupBy("source").transformWithStateInPandas(
        statefulProcessor=_Silence(rule, int(limit_seconds * 1000), int(hold * 1000)), outputStructType=SILENCES,
        outputMode="append", timeMode="ProcessingTime")

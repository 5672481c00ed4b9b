"""Inhibition and notifications on streams of alert changes.

The batch forms are ``operators.alerts.inhibit`` and ``notifications``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.operators import alerts
from quakeframe.streaming.keyed import Ordered

# A change of an alert: its labels, its role (a target is notified, a source mutes targets), and ``firing``
# or ``resolved`` at an instant. ``firing_ms`` tells the alerts of one set of labels apart.
ENTERS, LEAVES = "firing", "resolved"
TARGET, SOURCE, LOUD = "target", "source", "loud"  # a loud alert is notified whatever fires beside it


def changes_of(spells: DataFrame, role: str, labels: Sequence[str]) -> DataFrame:
    """Alerts with ``firing_at`` and ``resolved_at`` (null while open) as changes, with ``at`` as their event time."""
    row = lambda state, at: F.struct(F.lit(state).alias("state"), F.col(at).alias("at"))
    both = F.array(row(ENTERS, "firing_at"), F.when(F.col("resolved_at").isNotNull(), row(LEAVES, "resolved_at")))
    out = spells.select(*labels, F.lit(role).alias("role"), F.unix_millis("firing_at").alias("firing_ms"), F.explode(both).alias("c"))
    return out.where("c is not null").select(*labels, "role", "firing_ms", "c.state", "c.at")


class _Notify(Ordered):
    """The alerts of one set of equal labels that are or will be told, and the sources that mute them.

    A member leaves when its end was told, or when it ended before anything was sent. ``due`` is its next
    time to send, if nothing mutes it. Sources are kept as long as they fire.
    """

    def __init__(self, columns: Sequence[str], labels: Sequence[str], step_ms: int) -> None:
        self.columns, self.labels, self.step_ms = list(columns), list(labels), step_ms

    def empty(self) -> dict:
        return {"waiting": [], "members": [], "muted_by": []}

    def take(self, key, state, rows: pd.DataFrame) -> list[tuple]:
        for row in rows.itertuples():
            labels = [None if pd.isna(x) else x for x in (getattr(row, c) for c in self.labels)]
            state["waiting"].append([int(row.at_ms), row.state, row.role, labels, int(row.firing_ms), int(row.wait_ms), int(row.every_ms)])
        state["waiting"].sort(key=lambda w: (w[0], w[1] == ENTERS))  # what ends at an instant goes before what begins
        return []

    def next_at(self, key, state) -> int | None:
        times = [self._due(m, state) for m in state["members"]] + [w[0] for w in state["waiting"][:1]]
        return min((at for at in times if at is not None), default=None)

    def step(self, key, state, at) -> list[tuple]:
        was_muted = bool(state["muted_by"])
        while state["waiting"] and state["waiting"][0][0] <= at:
            self._change(state, *state["waiting"].pop(0))
        out, left = [], []
        for member in state["members"]:
            if was_muted and not state["muted_by"]:
                member["due"] = max(member["due"], self._grid(member, at))
            due = self._due(member, state)
            if member["end"] is not None:
                if member["repeat"] is None:
                    continue
                if due <= at:
                    out.append((*member["labels"], member["firing"], LEAVES, member["repeat"], due))
                    continue
            elif due is not None and due <= at:
                first = member["firing"] + member["wait"]
                member["repeat"] = (due - first) // member["every"]
                member["due"] = first + (member["repeat"] + 1) * member["every"]
                out.append((*member["labels"], member["firing"], ENTERS, member["repeat"], due))
            left.append(member)
        state["members"] = left
        return out

    def _grid(self, member: dict, at: int) -> int:
        """The first time to send at or after an instant."""
        first = member["firing"] + member["wait"]
        return first + max(0, -(-(at - first) // self.step_ms)) * self.step_ms

    def _due(self, member: dict, state: dict) -> int | None:
        if member["end"] is not None:
            return self._grid(member, member["end"])
        return None if state["muted_by"] and not member["loud"] else member["due"]

    def _change(self, state: dict, at: int, name: str, role: str, labels: list, firing: int, wait: int, every: int) -> None:
        if role == SOURCE:
            own = [labels, firing]
            if name == ENTERS and own not in state["muted_by"]:
                state["muted_by"].append(own)
            elif name == LEAVES and own in state["muted_by"]:
                state["muted_by"].remove(own)
            return
        loud = role == LOUD
        known = [m for m in state["members"] if (m["labels"], m["firing"], m["loud"]) == (labels, firing, loud)]
        if name == LEAVES:
            for member in known:
                member["end"] = at
        elif not known:
            state["members"].append({
                "labels": labels, "firing": firing, "end": None, "wait": wait, "every": every, "repeat": None, "due": firing + wait, "loud": loud})

    def idle(self, state) -> bool:
        return not state["members"] and not state["muted_by"]


def notification_stream(
    changes: DataFrame, equal: Sequence[str] = ("alertname", "region"), labels: Sequence[str] = ("alertname", "region", "severity"),
    routes=alerts.ROUTES, default: tuple[int, int] = alerts.DEFAULT_ROUTE, group_interval: int = alerts.GROUP_INTERVAL,
) -> DataFrame:
    """What is sent for a stream of alert changes: ``labels, firing_ms, status, repeat, sent_ms``.

    ``changes`` has ``labels``, ``role, firing_ms, state, at`` (see ``changes_of``) and a watermark on ``at``.
    Alerts wait, are sent again and are told to be over as the routes say, at times that lie ``group_interval``
    apart; targets aren't sent while a source with ``equal`` labels fires. The timers are of event time, so
    the rows are those of the batch form as far as the watermark has come. An alert is told by the instant at
    which it fires, so that a change which comes twice counts once. ``labels`` need the severity, by
    which alerts are routed. Needs the RocksDB state store.
    """
    routed = alerts.route(changes, routes, default)
    every = (F.ceil(F.col("repeat_interval") / group_interval) * group_interval * 1000).cast("bigint")
    rows = routed.select(
        *[F.col(c).alias(f"key_{c}") for c in equal], *labels, "role", "state", "firing_ms", "at", F.unix_millis("at").alias("at_ms"),
        (F.col("group_wait").cast("bigint") * 1000).alias("wait_ms"), every.alias("every_ms"))
    keys = [f"key_{c}" for c in equal]
    columns = [*keys, *labels, "firing_ms", "status", "repeat", "sent_ms"]
    schema = ", ".join([*(f"{c} string" for c in (*keys, *labels)), "firing_ms bigint", "status string", "repeat bigint", "sent_ms bigint"])
    out = rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Notify(columns, labels, group_interval * 1000), outputStructType=schema, outputMode="append", timeMode="EventTime")
    return out.drop(*keys)


# --- inhibition -------------------------------------------------------------------------------

class _Inhibit(Ordered):
    """Spells of targets and sources of one set of equal labels, and the parts of targets that were put out.

    A spell that comes in changes only the targets it overlaps: parts that no longer hold are taken back,
    new ones are put out. Spells leave ``keep_ms`` after their end, when no spell that overlaps them can
    come any more.
    """

    def __init__(self, columns: Sequence[str], keep_ms: int) -> None:
        self.columns, self.keep = list(columns), keep_ms

    def empty(self) -> dict:
        return {"targets": [], "sources": []}

    def take(self, key, state, rows: pd.DataFrame) -> list[tuple]:
        fresh, sources = [], []
        for row in rows.itertuples():
            spell = [int(row.start_us), int(row.end_us)]
            if row.role == SOURCE:
                sources.append(spell)
            else:
                fresh.append([*spell, row.own, []])
        state["sources"] = sorted(state["sources"] + sources)
        touched = [t for t in state["targets"] if any(a < t[1] and b > t[0] for a, b in sources)]
        state["targets"] += fresh
        out = []
        for target in touched + fresh:
            parts = _parts(target[0], target[1], state["sources"])
            out += [(target[2], -1, *p) for p in target[3] if p not in parts]
            out += [(target[2], 1, *p) for p in parts if p not in target[3]]
            target[3] = parts
        return out

    def _end(self, spell) -> int:
        return -(-spell[1] // 1000) + self.keep

    def next_at(self, key, state) -> int | None:
        return min((self._end(spell) for spell in (*state["targets"], *state["sources"])), default=None)

    def step(self, key, state, at) -> list[tuple]:
        for name in ("targets", "sources"):
            state[name] = [spell for spell in state[name] if self._end(spell) > at]
        return []


def _parts(start: int, end: int, sources: list[list[int]]) -> list[list[int]]:
    """What of ``[start, end)`` the sources, in order, leave free."""
    parts = []
    for low, high in sources:
        if low < end and high > start:
            if low > start:
                parts.append([start, low])
            start = max(start, high)
    return parts + ([[start, end]] if start < end else [])


def inhibition_stream(
    targets: DataFrame, sources: DataFrame, equal: Sequence[str], keep_seconds: int, start: str = "firing_at", end: str = "resolved_at",
) -> DataFrame:
    """The parts of targets in which no source with ``equal`` labels fires, as a log of changes.

    Both are streams of spells with a watermark on ``end``, which arrive in any order that the watermark
    allows. Each row of the result has the columns of a target and says that a part ``[part_start,
    part_end)`` of it holds (``change`` 1) or no longer does (-1), as a source that comes later may mute
    what was put out before. Summed up (``net_parts``) the log is the batch form.

    Spells are kept until the watermark is ``keep_seconds`` beyond their end. That is enough where no
    spell lasts longer: one that comes still later ends later by more than it lasts.
    """
    side = lambda df, role, own: df.select(
        *[F.col(c).cast("string").alias(f"key_{c}") for c in equal], F.lit(role).alias("role"), own.alias("own"),
        F.col(end).alias("ended"), F.unix_micros(start).alias("start_us"), F.unix_micros(end).alias("end_us"))
    keys = [f"key_{c}" for c in equal]
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    own = F.to_json(F.struct(*targets.columns), options)
    rows = side(targets, TARGET, own).unionByName(side(sources, SOURCE, F.lit(None).cast("string")))
    out = rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Inhibit([*keys, "own", "change", "start_us", "end_us"], keep_seconds * 1000),
        outputStructType=", ".join([*(f"{k} string" for k in keys), "own string, change int, start_us bigint, end_us bigint"]),
        outputMode="append", timeMode="EventTime")
    target = F.from_json("own", targets.schema, options)
    return out.select(target.alias("t"), "change", F.timestamp_micros("start_us").alias("part_start"), F.timestamp_micros("end_us").alias("part_end")).select(
        "t.*", "change", "part_start", "part_end")


def net_parts(log: DataFrame) -> DataFrame:
    """The parts that hold after all changes of a log."""
    columns = [c for c in log.columns if c != "change"]
    return log.groupBy(*columns).agg(F.sum("change").alias("change")).where("change > 0").drop("change")

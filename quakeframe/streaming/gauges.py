"""Gauges over look-backs, kept up to date between scrapes.

The batch form is ``operators.metrics.snapshot``, which reads a look-back for each scrape. Here an event is
added when it comes and evicted when it leaves, and a scrape reads one row per series.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quakeframe.operators import metrics
from quakeframe.sources.tables import delete
from quakeframe.streaming.compaction import complete
from quakeframe.streaming.corrections import read_statistic
from quakeframe.streaming.keyed import Ordered, delay_millis

SERIES = "metric string, region string, depth_bin string, value double, at_ms bigint"


@dataclass(frozen=True)
class Gauge:
    """``count`` of the events of a region in the look-back, their ``max`` magnitude, or that of the ``strongest`` with its depth as a label."""

    metric: str
    lookback_seconds: int
    kind: str


# Names and look-backs of the gauges over events.
GAUGES = (
    Gauge("earthquake_magnitude", 300, "strongest"), Gauge("earthquake_count_5min", 300, "count"),
    Gauge("max_earthquake_magnitude_24h", 86_400, "max"),
)


class _LookBack(Ordered):
    """One series: what will enter and what is in the look-back, as [enter, leave, number, best].

    For a maximum the queue is monotone: an entry drives out the weaker ones before it, so the head is the
    value and what waits behind it are the values to come as the head leaves. For a count it has the number
    of events of each millisecond, and their total beside it.

    With a ``delay``, what will have left by the next watermark never enters the state, nor does what something
    stronger will have driven out by then: no value is told in between.
    """

    columns = ["metric", "region", "depth_bin", "value", "at_ms"]
    queues = ["waiting", "inside"]

    def __init__(self, gauges: dict[str, Gauge], delay: int | None = None) -> None:
        self.gauges, self.delay = gauges, delay

    def empty(self) -> dict:
        return {"waiting": [], "inside": [], "total": 0, "said": None}

    def take(self, key, state, rows: pd.DataFrame) -> list[tuple]:
        if not isinstance(state["waiting"], dict):
            state["waiting"] = {(a, b): [n, best] for a, b, n, best in state["waiting"]}
        waiting, at = state["waiting"], ["enter_ms", "leave_ms"]
        if self.delay is not None and len(rows):
            until = max([int(rows["enter_ms"].max()), *(enter for enter, _ in waiting)]) - 1 - self.delay
            rows = rows[self._matters(key, rows, until)]
            self._forget(key, waiting, until)
        rows = rows.sort_values([*at, "magnitude", "time_us", "event_id", "depth_bin"])
        number = rows.groupby(at).size()
        for row in rows.drop_duplicates(at, keep="last").itertuples():
            instant, own = (int(row.enter_ms), int(row.leave_ms)), [float(row.magnitude), int(row.time_us), row.event_id, row.depth_bin]
            n, other = waiting.get(instant, (0, own))
            waiting[instant] = [n + int(number[instant]), max(own, other)]
        return []

    def _matters(self, key, rows: pd.DataFrame, until: int) -> np.ndarray:
        """Which rows may matter at a watermark of ``until`` or later, or do at once."""
        enter, magnitude = rows["enter_ms"].to_numpy(), rows["magnitude"].to_numpy("f8")
        now = enter <= self.now
        stays = rows["leave_ms"].to_numpy() > until
        if self.gauges[key[0]].kind != "count":
            latest = np.argsort(-rows["time_us"].to_numpy(), kind="stable")
            strongest = np.empty_like(magnitude)  # of what enters then or later, as far as that is sure
            strongest[latest] = np.fmax.accumulate(np.where((enter <= until) & ~now, magnitude, -np.inf)[latest])
            stays &= ~(magnitude < strongest) | (enter > until)
        return now | stays

    def _forget(self, key, waiting: dict, until: int) -> None:
        strongest = None
        for at in sorted(waiting, reverse=True):
            if self.now < at[0] <= until:
                best = waiting[at][1][:3]
                driven = self.gauges[key[0]].kind != "count" and strongest is not None and best < strongest
                if driven or at[1] <= until:
                    del waiting[at]
                strongest = best if strongest is None else max(best, strongest)

    def taken(self, key, state) -> None:
        if isinstance(state["waiting"], dict):
            state["waiting"] = deque([*at, *entry] for at, entry in sorted(state["waiting"].items()))

    def next_at(self, key, state) -> int | None:
        return min([queue[0][i] for i, queue in ((0, state["waiting"]), (1, state["inside"])) if queue], default=None)

    def step(self, key, state, at) -> list[tuple]:
        inside, counts = state["inside"], self.gauges[key[0]].kind == "count"
        while inside and inside[0][1] <= at:
            state["total"] -= inside.popleft()[2]
        while state["waiting"] and state["waiting"][0][0] <= at:
            entry = state["waiting"].popleft()
            while not counts and inside and inside[-1][3][:3] < entry[3][:3]:
                inside.pop()
            inside.append(entry)
            state["total"] += entry[2]
        return []

    def settle(self, key, state) -> list[tuple]:
        """The value, if it is another than the one put out last; without one once the look-back is empty."""
        kind, inside = self.gauges[key[0]].kind, state["inside"]
        value = None if not inside else float(state["total"]) if kind == "count" else inside[0][3][0]
        label = inside[0][3][3] if inside and kind == "strongest" else None
        if [label, value] == state["said"] or (value is None and state["said"] is None):
            return []
        state["said"] = None if value is None else [label, value]
        return [(label, value, self.now)]


def gauge_stream(points: DataFrame, gauges: tuple[Gauge, ...] = GAUGES, delay: str | None = None) -> DataFrame:
    """Changes of all series as the watermark goes on, one row per series and micro-batch at most; a null value ends a series.

    ``points`` has a watermark on ``time``, which is the instant that the gauges are of. With its ``delay`` (or a
    longer one) the state of a series is bounded by what its look-back and the delay hold, however much comes in
    a micro-batch; without, it also has all that the watermark has not reached. Needs the RocksDB state store and update mode.
    """
    micros, each = F.unix_micros("time"), []
    for gauge in gauges:
        leave = F.floor((micros + gauge.lookback_seconds * 1_000_000) / 1000) + 1  # both ends of a look-back belong to it
        each.append(F.struct(F.lit(gauge.metric).alias("metric"), F.ceil(micros / 1000).cast("bigint").alias("enter_ms"), leave.cast("bigint").alias("leave_ms")))
    rows = points.select("region", "depth_bin", "magnitude", "time", micros.alias("time_us"), "event_id", F.explode(F.array(*each)).alias("g"))
    rows = rows.select("g.*", "region", "depth_bin", "magnitude", "time", "time_us", "event_id")
    return rows.groupBy("metric", "region").transformWithStateInPandas(
        statefulProcessor=_LookBack({g.metric: g for g in gauges}, delay_millis(points.sparkSession, delay)), outputStructType=SERIES, outputMode="update", timeMode="EventTime")


# --- the keyed table --------------------------------------------------------------------------

def write_series(
    changes: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = "15 seconds",
    keys: Sequence[str] = ("metric", "region"), alive: str = "value is not null",
) -> StreamingQuery:
    """Keeps a table with one row per series. Each micro-batch writes it anew as the next version, whole or not at all.

    The table has a row for each value of ``keys`` that is ``alive``, so a version is small. A batch that runs
    again writes its own version again from the one before it. The last two versions stay for readers. Where a
    series is kept in parts, each by a task of its own, ``part`` is one of the keys.
    """
    schema = changes.schema
    keys = [*keys, *(name for name in schema.names if name == "part")]

    def save(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [v for v in complete(spark, path, "version") if v < number]
        rows = batch.where(alive)
        if before:
            old = spark.read.schema(schema).parquet(f"{path}/version={before[-1]}")
            rows = old.join(batch.select(*keys), keys, "left_anti").select(*batch.columns).unionByName(rows)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={number}")
        for version in before[:-1]:
            delete(spark, f"{path}/version={version}")

    writer = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def read_series(spark: SparkSession, path: str, schema: str = SERIES) -> DataFrame:
    """The series as of the last micro-batch."""
    versions = complete(spark, path, "version")
    return spark.read.schema(schema).parquet(f"{path}/version={versions[-1]}") if versions else spark.createDataFrame([], schema)


def scrape(spark: SparkSession, root: str, as_of: Column) -> DataFrame:
    """All gauges of a live root: those over events as they are kept, those over statistics from their last hour."""
    tables = [read_series(spark, f"{root}/gauges").select("metric", "region", "depth_bin", "value")]
    hourly, sequences = (read_statistic(spark, root, name) for name in ("hourly_global_stats", "sequence_detection"))
    tables.append(metrics.hourly_gauges(hourly, as_of))
    tables.append(metrics.sequence_gauges(sequences, as_of))
    return tables[0].unionByName(tables[1]).unionByName(tables[2])

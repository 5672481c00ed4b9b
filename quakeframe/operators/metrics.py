"""Operational metrics: full snapshots at an instant, and timelines on an evaluation grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.functions import bins, times
from quakeframe.operators.panels import since


def strongest(*extra: str, time: str = "time", tie: str = "event_id") -> Column:
    """The strongest event of a group; of equal ones the latest, then the greatest id."""
    return F.max(F.struct("magnitude", time, tie, *extra))


def recent_count(points: DataFrame, as_of=None, minutes: int = 5) -> DataFrame:
    return since(points, as_of, mins=minutes).groupBy("region").agg(F.count(F.lit(1)).alias("eq_count"))


def recent_strongest(points: DataFrame, as_of=None, minutes: int = 5) -> DataFrame:
    best = since(points, as_of, mins=minutes).groupBy("region").agg(strongest("depth_bin").alias("best"))
    return best.select("region", "best.depth_bin", "best.magnitude")


def latest_hourly(hourly: DataFrame, as_of=None, hours: int = 1) -> DataFrame:
    """The last hourly statistics per region; the live path writes only ``global``."""
    rows = since(hourly, as_of, hours=hours).groupBy("region").agg(
        F.max("time").alias("time"),
        *[F.max_by(f, "time").alias(f) for f in ("eq_count", "avg_mag", "max_mag")],
    )
    return rows


def active_sequences(sequences: DataFrame, as_of=None, hours: int = 1, min_count: int = 3) -> DataFrame:
    rows = since(sequences, as_of, hours=hours).where(F.col("eq_count") >= min_count)
    return rows.select("time", "region", "eq_count", "max_mag", "avg_mag")


def swarm_flag(sequences: DataFrame, as_of=None, hours: int = 1, min_count: int = 3) -> DataFrame:
    """A flag of 1 per region with a sequence, and the size of the latest (then largest) one."""
    rows = active_sequences(sequences, as_of, hours, min_count)
    latest = F.max(F.struct("time", "eq_count"))["eq_count"].alias("sequence_count")
    return rows.groupBy("region").agg(F.lit(1).alias("swarm_detected"), latest)


def max_magnitude(points: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    return since(points, as_of, hours=hours).groupBy("region").agg(F.max("magnitude").alias("max_magnitude"))


def points_processed(points: DataFrame, every: str = "1 day") -> DataFrame:
    """Rows per bucket and source and their running total: the value of a counter at each read.

    The running total is over one row per bucket and source.
    """
    counts = points.groupBy(F.window("time", every).alias("w"), "source").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.partitionBy("source").orderBy("w.end"))
    return counts.select(F.col("w.end").alias("time"), "source", "n", running.alias("total"))


def significant_totals(points: DataFrame) -> DataFrame:
    strong = points.where(F.col("magnitude") >= bins.SIGNIFICANT_FROM)
    return strong.groupBy("region", "mag_bin").agg(F.count(F.lit(1)).alias("total"))


def activity_level(points: DataFrame, as_of=None, hours: int = 1) -> DataFrame:
    return since(points, as_of, hours=hours).groupBy("region").agg(F.count(F.lit(1)).alias("level"))


def freshness(points: DataFrame, as_of: Column) -> DataFrame:
    """Latest event per source and its age in seconds at ``as_of``."""
    newest = points.groupBy("source").agg(F.max("time").alias("last_update"))
    return newest.withColumn("age_seconds", times.seconds(F.col("last_update"), as_of))


_SNAPSHOT = (
    "earthquake_magnitude", "earthquake_count_5min", "earthquake_count_hourly", "earthquake_swarm_detected",
    "earthquake_sequence_count", "max_earthquake_magnitude_24h",
)


def _gauges(df: DataFrame, *gauges: tuple[str, Column, Column | None]) -> DataFrame:
    """Rows (metric, region, depth_bin, value) from the columns of one row per region; null values are left out."""
    rows = [
        F.struct(F.lit(metric).alias("metric"), (F.lit(None).cast("string") if label is None else label).alias("depth_bin"),
                 value.cast("double").alias("value"))
        for metric, value, label in gauges
    ]
    return df.select("region", F.inline(F.array(*rows))).where("value is not null").select("metric", "region", "depth_bin", "value")


def hourly_gauges(hourly: DataFrame, as_of: Column) -> DataFrame:
    return _gauges(latest_hourly(hourly, as_of), ("earthquake_count_hourly", F.col("eq_count"), None))


def sequence_gauges(sequences: DataFrame, as_of: Column) -> DataFrame:
    return _gauges(swarm_flag(sequences, as_of), ("earthquake_swarm_detected", F.col("swarm_detected"), None),
                   ("earthquake_sequence_count", F.col("sequence_count"), None))


def snapshot(points: DataFrame, hourly: DataFrame, sequences: DataFrame, as_of: Column) -> DataFrame:
    """All gauges at one instant as (metric, region, label, value). Old labels never persist.

    Each table is read once: the gauges of five minutes and of a day are parts of one aggregation.
    """
    recent = F.col("time") >= as_of - F.make_dt_interval(mins=F.lit(5))
    by_region = since(points, as_of, hours=24).groupBy("region").agg(
        F.max(F.when(recent, F.struct("magnitude", "time", "event_id", "depth_bin"))).alias("best"),
        F.count_if(recent).alias("n"), F.max("magnitude").alias("max_magnitude"),
    )
    tables = [
        _gauges(by_region, ("earthquake_magnitude", F.col("best.magnitude"), F.col("best.depth_bin")),
                ("earthquake_count_5min", F.when(F.col("n") > 0, F.col("n")), None),
                ("max_earthquake_magnitude_24h", F.col("max_magnitude"), None)),
        hourly_gauges(hourly, as_of), sequence_gauges(sequences, as_of),
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


# --- timelines --------------------------------------------------------------------------------

# A rule is evaluated at instants that are multiples of a step. An event at time t is seen at the
# instants in [t, t + lookback]. Timelines are tables of spells [start, end) between instants, in
# which a value does not change.

def _seen(time: Column, lookback_seconds: int, step_seconds: int) -> tuple[Column, Column]:
    """First instant that sees an event, and the first one after that no longer does."""
    micros, step = F.unix_micros(time), F.lit(step_seconds * 1_000_000)
    until = micros + lookback_seconds * 1_000_000
    return micros + F.pmod(-micros, step), until - F.pmod(until, step) + step


def count_timeline(
    points: DataFrame, keys: Sequence[str] = ("region",), lookback_seconds: int = 300,
    step_seconds: int = 15, at_least: int = 1,
) -> DataFrame:
    """Spells in which at least so many events are in the look-back, with their number.

    An event adds one at the instant it enters and takes one away when it leaves; the running sum
    of these changes is the count. Nothing is copied per instant, events of one step are counted
    before the shuffle, and cutting spells at midnight lets the sum run per key and day.
    """
    day = F.lit(86_400_000_000)
    first, gone = _seen(F.col("time"), lookback_seconds, step_seconds)
    counted = points.select(*keys, first.alias("first"), gone.alias("gone")).groupBy(
        *keys, "first", "gone"
    ).agg(F.count(F.lit(1)).alias("n"))
    midnight = lambda c: c - F.pmod(c, day)
    days = F.sequence(midnight(F.col("first")), midnight(F.col("gone") - 1), day)
    changes = counted.select(*keys, "first", "gone", "n", F.explode(days).alias("day")).select(
        *keys, "day", F.inline(F.array(
            F.struct(F.greatest("first", "day").alias("at"), F.col("n").alias("change")),
            F.struct(F.least("gone", F.col("day") + day).alias("at"), (-F.col("n")).alias("change")),
        )))
    # One shuffle by key and day serves the sum, the running sum and the joining of spells.
    order = Window.partitionBy(*keys, "day").orderBy("at")
    levels = (
        changes.repartition(*keys, "day").groupBy(*keys, "day", "at").agg(F.sum("change").alias("change"))
        .select(*keys, "day", "at", F.lead("at").over(order).alias("until"), F.sum("change").over(order).alias("value"))
    )
    return levels.where(F.col("value") >= at_least).select(
        *keys, "day", F.timestamp_micros("at").alias("start"), F.timestamp_micros("until").alias("end"), "value"
    )


def strongest_timeline(
    points: DataFrame, above: float, lookback_seconds: int = 300, step_seconds: int = 15,
) -> DataFrame:
    """One spell per region and instant whose strongest event is above a threshold.

    Weaker events cannot be the strongest there, so they are dropped at the scan. Only the
    strongest event of each step is copied to the instants that see it.
    """
    first, gone = _seen(F.col("time"), lookback_seconds, step_seconds)
    per_step = (
        points.where(F.col("magnitude") > above)
        .groupBy("region", first.alias("first"), gone.alias("gone"))
        .agg(strongest("depth_bin").alias("best"))
    )
    step = step_seconds * 1_000_000
    instants = F.explode(F.sequence(F.col("first"), F.col("gone") - step, F.lit(step))).alias("at")
    # One shuffle by region and day serves the choice of the strongest and the joining of spells.
    seen = per_step.select("region", "best", instants).withColumn("day", F.floor(F.col("at") / 86_400_000_000))
    return (
        seen.repartition("region", "day").groupBy("region", "day", "at").agg(F.max("best").alias("best")).select(
            "region", "best.depth_bin", "day", F.timestamp_micros("at").alias("start"),
            F.timestamp_micros(F.col("at") + step).alias("end"), F.col("best.magnitude").alias("value"),
        )
    )

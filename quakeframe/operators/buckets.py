"""Time buckets of stored points, gap filling, islands and gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quakeframe.functions import times
from quakeframe.functions.exact import exact_avg, exact_sum


def bucket_mean(
    df: DataFrame, keys: Sequence[str], value: str, every: str = "1 day", time: str = "time",
) -> DataFrame:
    """Mean per bucket and key, labelled with the end of the bucket; empty buckets are absent.

    Whole numbers are summed as such and others by ``exact_sum``, so the mean is one division and
    does not depend on the order of rows.
    """
    window = F.window(time, every).alias("bucket")
    whole = dict(df.dtypes)[value] in ("tinyint", "smallint", "int", "bigint")
    sums = [F.sum(F.col(value).cast("bigint")).alias("total")] if whole else exact_sum(F.col(value).cast("double"), "total")
    grouped = df.groupBy(window, *keys).agg(*sums, F.count(value).alias("n"))
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n") if whole else exact_avg("total", F.col("n")))
    return grouped.select(F.col("bucket.end").alias("time"), *keys, mean.alias("value"))


def bucket_count(df: DataFrame, keys: Sequence[str], every: str = "1 minute", time: str = "time") -> DataFrame:
    window = F.window(time, every).alias("bucket")
    return df.groupBy(window, *keys).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("bucket.end").alias("time"), *keys, "n"
    )


STEPS = {"day": "interval 1 day", "month": "interval 1 month", "year": "interval 12 month"}


def spine(spark: SparkSession, start: Column, stop: Column, unit: str = "day") -> DataFrame:
    """One row per calendar unit between two instants, from literals or scalar subqueries."""
    units = F.sequence(F.date_trunc(unit, start), F.date_trunc(unit, stop), F.expr(STEPS[unit]))
    return spark.range(1).select(F.explode(units).alias("bucket"))


def calendar_count(
    df: DataFrame, keys: Sequence[str], unit: str = "day", spine: DataFrame | None = None,
    time: str = "time",
) -> DataFrame:
    """Count per calendar unit (day, month, year) with zeros for empty ones.

    Without a spine each key is filled between its own first and last unit. Events are counted
    before anything is joined: both sides have at most one row per key and unit.
    """
    counts = df.groupBy(*keys, F.date_trunc(unit, F.col(time)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if spine is None:
        spine = counts.groupBy(*keys).agg(F.min("bucket").alias("low"), F.max("bucket").alias("high")).select(
            *keys, F.explode(F.sequence("low", "high", F.expr(STEPS[unit]))).alias("bucket")
        )
    return spine.join(counts, [*keys, "bucket"], "left").select(
        *keys, "bucket", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


_DAY = 86_400_000_000


def islands(df: DataFrame, keys: Sequence[str], peak: str) -> DataFrame:
    """Joins spells ``[start, end)`` of one key that touch or overlap; ``peak`` becomes their maximum.

    Spells are cut at midnight and joined within each day, so that a key which is active all the time is
    spread over its days. What is left of a day are spells apart from each other, of which only the first can
    begin at midnight and only the last can end there. Just these go on to be joined over midnight: two rows
    a key and day at most, however many spells there are. A ``day`` column says that spells are cut already;
    where the input is partitioned by it, that saves a shuffle.
    """
    def joined(frame: DataFrame, by: Sequence[str]) -> DataFrame:
        order = Window.partitionBy(*by).orderBy("start", "end")
        reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
        fresh = F.when(F.coalesce(F.col("start") > reached, F.lit(True)), 1).otherwise(0)
        runs = frame.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(order))
        return runs.groupBy(*by, "_run").agg(
            F.min("start").alias("start"), F.max("end").alias("end"), F.max(peak).alias(peak)
        ).drop("_run")

    at_midnight = lambda c: F.pmod(F.unix_micros(c), F.lit(_DAY)) == 0
    within = joined(df if "day" in df.columns else _cut(df), [*keys, "day"]).drop("day")
    border = at_midnight("start") | at_midnight("end")
    return within.where(~border).unionByName(joined(within.where(border), keys))


def _cut(df: DataFrame) -> DataFrame:
    """Spells cut at midnight, with the ``day`` that each part lies in."""
    low, high = F.unix_micros("start"), F.unix_micros("end")
    midnight = lambda c: c - F.pmod(c, F.lit(_DAY))
    days = F.sequence(midnight(low), F.greatest(midnight(high - 1), midnight(low)), F.lit(_DAY))
    parts = df.withColumns({"_low": low, "_high": high}).withColumn("day", F.explode(days))
    return parts.withColumns({
        "start": F.timestamp_micros(F.greatest("_low", "day")), "end": F.timestamp_micros(F.least("_high", F.col("day") + _DAY)),
    }).drop("_low", "_high")


def silences(df: DataFrame, limit_seconds: int, time: str = "event_time", as_of: Column | None = None) -> DataFrame:
    """Gaps between neighbouring events that are longer than the limit.

    With ``as_of`` events after it don't count, and the gap from the last event up to it is one more,
    marked ``open``.

    No gap above the limit fits inside a bucket of that width, so first and last time per
    bucket are enough: the events themselves are never sorted. Buckets are compared within a day
    and days with each other, the latter being one row per day.
    """
    first, last = F.min("first").alias("first"), F.max("last").alias("last")
    df = df if as_of is None else df.where(F.col(time) <= as_of)
    spans = df.groupBy(times.floor_to(F.col(time), limit_seconds).alias("bucket")).agg(
        F.min(time).alias("first"), F.max(time).alias("last")
    ).withColumn("day", F.to_date("bucket"))

    def gaps(frame: DataFrame, order) -> DataFrame:
        return frame.select(F.lag("last").over(order).alias("gap_start"), F.col("first").alias("gap_end"))

    within = gaps(spans, Window.partitionBy("day").orderBy("bucket"))
    # One row per day of data, whatever the number of events.
    across = gaps(spans.groupBy("day").agg(first, last), Window.orderBy("day"))
    found = within.unionByName(across)
    if as_of is not None:
        running = spans.agg(F.max("last").alias("gap_start")).select("gap_start", as_of.alias("gap_end"), F.lit(True).alias("open"))
        found = found.withColumn("open", F.lit(False)).unionByName(running)
    return found.withColumn(
        "gap_seconds", times.seconds(F.col("gap_start"), F.col("gap_end"))
    ).where(F.col("gap_seconds") > limit_seconds)

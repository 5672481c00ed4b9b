"""Dashboard queries over stored points: latest rows, top-k, totals, trends and overlays."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.functions import bins
from quakeframe.operators import buckets
from quakeframe.sources.catalogue import as_of_column, has_date
from quakeframe.sources.tables import newest, range_filter


def _before(as_of: Column, **interval: int) -> Column:
    return as_of - F.make_dt_interval(**{k: F.lit(v) for k, v in interval.items()})


def since(df: DataFrame, as_of=None, time: str = "time", **interval: int) -> DataFrame:
    """The last ``interval`` up to and including ``as_of``, by default the latest row."""
    end = as_of_column(df, time) if as_of is None else as_of
    start = _before(end, **interval)
    out = df.where((F.col(time) >= start) & (F.col(time) <= end))
    if has_date(df):  # prunes the folders of a table kept by date
        out = out.where(F.col("date").between(F.to_date(start), F.to_date(end)))
    return out


# --- latest rows ------------------------------------------------------------------------------

def latest(df: DataFrame, n: int, *columns: str, time: str = "time", tie: str = "event_id") -> DataFrame:
    """Each task keeps n rows and only those are merged (TakeOrderedAndProject)."""
    out = df.orderBy(F.col(time).desc(), F.col(tie)).limit(n)
    return out.select(*columns) if columns else out


def _newest(points: DataFrame, n: int, rows: Callable[[DataFrame], DataFrame], days: Sequence[str] | None) -> DataFrame:
    """The rows to sort: of a table by date whose ``days`` are given (``tables.days_of``), those of the newest days that suffice."""
    return rows(points) if days is None else newest(points, days, n, rows)


def live_feed(points: DataFrame, n: int = 50, start=None, stop=None, days: Sequence[str] | None = None) -> DataFrame:
    rows = _newest(points, n, lambda df: range_filter(df, start, stop).dropna(subset=["magnitude", "place"]), days)
    return latest(rows, n, "time", "place", "magnitude")


def event_map(
    points: DataFrame, n: int = 1000, region: str | None = None, start=None, stop=None, days: Sequence[str] | None = None,
) -> DataFrame:
    """Latest positioned events with their display band, optionally of regions matching a pattern."""
    def rows(df: DataFrame) -> DataFrame:
        found = range_filter(df, start, stop).dropna(subset=["magnitude", "latitude", "longitude"])
        return found if region is None else found.where(F.col("region").rlike(region))

    top = latest(_newest(points, n, rows, days), n, "time", "event_id", "magnitude", "latitude", "longitude", "place")
    return top.withColumn("band", bins.band(F.col("magnitude"), bins.MAP_BANDS))


def recent_alerts(points: DataFrame, n: int = 20, start=None, stop=None, days: Sequence[str] | None = None) -> DataFrame:
    strong = _newest(points, n, lambda df: range_filter(df, start, stop).where(F.col("magnitude") >= bins.SIGNIFICANT_FROM), days)
    top = latest(strong, n, "time", "region", "magnitude")
    return top.select(
        "time", "region", F.col("magnitude").alias("max_magnitude"),
        bins.panel_alert_level(F.col("magnitude")).alias("alert_level"),
    )


def latest_events(points: DataFrame, as_of=None, minutes: int = 5) -> DataFrame:
    rows = since(points, as_of, mins=minutes)
    return rows.select("time", "magnitude", "region", "depth_bin", "latitude", "longitude").orderBy(
        F.col("time").desc()
    )


# --- totals -----------------------------------------------------------------------------------

def union(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def count_totals(keys: Sequence[str], *tables: DataFrame) -> DataFrame:
    """Sum of ``eq_count`` per key over all tables, which may have other columns besides."""
    rows = reduce(DataFrame.unionByName, [t.select(*keys, "eq_count") for t in tables])
    return rows.groupBy(*keys).agg(F.sum("eq_count").alias("eq_count"))


def depth_totals(*tables: DataFrame) -> DataFrame:
    totals = count_totals(["depth_bin"], *tables)
    return totals.select(bins.depth_label(F.col("depth_bin")).alias("label"), "eq_count")


def significant_max(points: DataFrame, start=None, stop=None) -> DataFrame:
    """The strongest significant event of each region; of equal ones the earliest."""
    strong = range_filter(points, start, stop).where(F.col("magnitude") >= bins.SIGNIFICANT_FROM)
    best = F.min(F.struct((-F.col("magnitude")).alias("m"), "time", "event_id"))
    return strong.groupBy("region").agg(best.alias("best")).select(
        "region", (-F.col("best.m")).alias("magnitude"), "best.time", "best.event_id"
    )


def regional_activity(weekly: DataFrame, rolling: DataFrame, n: int = 20) -> DataFrame:
    """Regions by event count over weekly and 7-day statistics.

    The ``sum_`` columns add averages and maxima as the dashboard does; the count-weighted
    average and the true maximum stand beside them. Inputs have two decimals or three, so their
    sums are formed from whole thousandths and do not depend on the order.
    """
    columns = ["region", "eq_count", "avg_mag", "max_mag"]
    rows = weekly.select(*columns).unionByName(rolling.select(*columns))
    milli = lambda c: F.rint(F.col(c) * 1000).cast("bigint")
    grouped = rows.groupBy("region").agg(
        F.sum("eq_count").alias("eq_count"),
        (F.sum(milli("avg_mag")) / 1000).alias("sum_avg_mag"),
        (F.sum(milli("max_mag")) / 1000).alias("sum_max_mag"),
        (F.sum(milli("avg_mag") * F.col("eq_count")).cast("double")
         / (F.sum("eq_count") * 1000)).alias("weighted_avg_mag"),
        F.max("max_mag").alias("max_mag"),
    )
    return grouped.orderBy(F.col("eq_count").desc(), "region").limit(n)


def most_active(weekly: DataFrame, rolling: DataFrame, n: int = 15) -> DataFrame:
    totals = count_totals(["region"], weekly, rolling)
    return totals.orderBy(F.col("eq_count").desc(), "region").limit(n)


def last_value(stats: DataFrame, field: str, as_of=None, keys: Sequence[str] = ("source",), **interval: int) -> DataFrame:
    """The latest value of a field in each series, with the time it belongs to."""
    rows = since(stats, as_of, **(interval or {"days": 7})).where(F.col(field).isNotNull())
    return rows.groupBy(*keys).agg(
        F.max("time").alias("time"), F.max_by(field, "time").alias(field)
    )


def storage_statistics(**tables: DataFrame) -> DataFrame:
    """Number of stored points per measurement; a measurement without points counts zero."""
    counts = [
        t.agg(F.count(F.lit(1)).alias("total_records")).select(F.lit(name).alias("measurement"), "total_records")
        for name, t in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# --- trends -----------------------------------------------------------------------------------

def activity_trends(weekly: DataFrame, rolling: DataFrame) -> DataFrame:
    rows = weekly.select("time", "region", "eq_count").unionByName(rolling.select("time", "region", "eq_count"))
    return buckets.bucket_mean(rows, ["region"], "eq_count", "1 day")


def count_trend(stats: DataFrame, every: str) -> DataFrame:
    return buckets.bucket_mean(stats, ["source"], "eq_count", every)


def batch_vs_stream(batch: DataFrame, stream: DataFrame) -> DataFrame:
    return count_trend(batch, "1 day").unionByName(count_trend(stream, "1 minute"))


def ingestion_rate(points: DataFrame, as_of=None) -> DataFrame:
    """Events per second and source for each minute of the last hour that has events."""
    rows = buckets.bucket_count(since(points, as_of, hours=1), ["source"], "1 minute")
    return rows.select("time", "source", (F.col("n") / 60.0).alias("rate"))


# Panel, source of its points (all if none), calendar unit and range.
LIVENESS = [
    ("streaming", "stream", "day", {"days": 1}), ("batch", "batch", "year", {"months": 12}),
    ("producer", None, "day", {"days": 1}), ("store", None, "day", {"days": 1}),
]


def source_liveness(points: DataFrame, as_of: Column, panels=LIVENESS) -> DataFrame:
    """The status panels: a flag per calendar unit of a panel's range, 1 where points arrived, 0 where none did.

    The points are read once. Each names the panels and units that it counts for, and what is left
    after counting, a row per panel and unit, is joined to the units of all panels.
    """
    time, hits, units, starts = F.col("time"), [], [], []
    back = lambda end, months=None, **rest: (
        end - F.make_ym_interval(months=F.lit(months)) if months else _before(end, **rest))
    for panel, source, unit, interval in panels:
        start = back(as_of, **interval)
        hit = (time >= start) if source is None else (time >= start) & (F.col("source") == source)
        hits.append(F.when(hit, F.struct(F.lit(panel).alias("panel"), F.date_trunc(unit, time).alias("bucket"))))
        now = F.col("now")
        days = F.sequence(F.date_trunc(unit, back(now, **interval)), F.date_trunc(unit, now), F.expr(buckets.STEPS[unit]))
        named = F.array_repeat(F.lit(panel), F.size(days))
        units.append(F.arrays_zip(named.alias("panel"), days.alias("bucket")))
        starts.append(start)
    recent = points.where((time >= F.least(*starts)) & (time <= as_of))
    hit = recent.select(F.explode(F.array(*hits)).alias("hit")).where("hit is not null").select("hit.*")
    counts = hit.groupBy("panel", "bucket").agg(F.count(F.lit(1)).alias("n"))
    spine = points.sparkSession.range(1).select(as_of.alias("now")).select(F.inline(F.concat(*units)))
    flag = F.when(F.col("n") > 0, 1).otherwise(0)
    status = reduce(
        lambda text, panel: F.when(F.col("panel") == panel[0], bins.flag_text(flag, panel[0])).otherwise(text),
        panels, F.lit(None).cast("string"))
    return spine.join(counts, ["panel", "bucket"], "left").select("panel", "bucket", flag.alias("flag"), status.alias("status"))


def series_names(df: DataFrame) -> DataFrame:
    """Columns named ``_value<label>`` take the label as their name."""
    import re

    return df.toDF(*[re.sub(r"^_value(.+)$", r"\1", name) for name in df.columns])

"""Time-series points: tags, fields and a time, in a wide and a long form.

The wide form (one table per measurement) is what is stored and queried. The long form has one
row per field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.functions import bins, times
from quakeframe.schema import MEASUREMENTS, Measurement


def _or_unknown(name: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit("Unknown")).alias(name)


def event_points(df: DataFrame) -> DataFrame:
    """Events that can be stored: position, magnitude and time are needed."""
    complete = df.dropna(subset=["event_time", "mag", "latitude", "longitude"])
    return complete.select(
        F.col("event_time").alias("time"),
        _or_unknown("region"), _or_unknown("mag_bin"), _or_unknown("depth_bin"), "source",
        F.nullif(F.col("magType"), F.lit("")).alias("mag_type"),
        F.col("mag").alias("magnitude"), "latitude", "longitude", "depth",
        F.col("id").alias("event_id"),
        F.nullif(F.col("place"), F.lit("")).alias("place"),
    )


def _stat_points(df: DataFrame, measurement: str, time: Column, source: str, **derived: Column) -> DataFrame:
    m = MEASUREMENTS[measurement]
    out = df.withColumns({"time": time.cast("timestamp"), "source": F.lit(source), **derived})
    spans = [c for c in m.texts if c.endswith("event_time")]
    if spans:
        out = out.withColumns({c: times.iso_text(F.col(c)) for c in spans})
    # The ``window`` of a statistic, if it is named, stays beside the point: neighbouring windows share times.
    window = ["window"] if "window" in df.columns else []
    return out.select("time", *[F.col(tag).cast("string").alias(tag) for tag in m.tags], *m.fields, *window)


def daily_points(stats: DataFrame) -> DataFrame:
    return _stat_points(stats, "daily_global_stats", F.col("date"), "batch")


def weekly_points(stats: DataFrame) -> DataFrame:
    """At the Monday of the ISO week; exact over New Year if the statistics have ``iso_year``."""
    year = F.col("iso_year" if "iso_year" in stats.columns else "year")
    start = times.iso_week_start(year, F.col("week"))
    return _stat_points(stats, "weekly_regional_stats", start, "batch")


def monthly_points(stats: DataFrame, measurement: str = "monthly_regional_stats") -> DataFrame:
    """Also for the magnitude and the depth distribution."""
    return _stat_points(stats, measurement, times.month_start(F.col("year"), F.col("month")), "batch")


def global_stream_points(stats: DataFrame, measurement: str = "hourly_global_stats") -> DataFrame:
    return _stat_points(
        stats, measurement, F.col("min_event_time"), "stream", region=F.lit("global")
    )


def rolling_points(stats: DataFrame, window_type: str) -> DataFrame:
    return _stat_points(
        stats, "rolling_regional_stats", F.col("min_event_time"), "stream",
        window_type=F.lit(window_type),
    )


def alert_points(stats: DataFrame) -> DataFrame:
    return _stat_points(
        stats, "significant_event_alerts", F.col("min_event_time"), "stream",
        alert_level=bins.alert_level(F.col("max_mag")),
    )


def stream_points(stats: DataFrame, measurement: str) -> DataFrame:
    """The magnitude and depth distributions of the live path."""
    return _stat_points(stats, measurement, F.col("min_event_time"), "stream")


def sequence_points(stats: DataFrame) -> DataFrame:
    return _stat_points(
        stats, "sequence_detection", F.col("min_event_time"), "stream",
        first_event_time=F.col("min_event_time"), last_event_time=F.col("max_event_time"),
        lat_grid=F.col("lat_grid").cast("double"), lon_grid=F.col("lon_grid").cast("double"),
    )


# --- long form --------------------------------------------------------------------------------

def tag_map(tags: Sequence[str]) -> Column:
    """Tags as text; a missing tag is left out."""
    pairs = [c for name in sorted(tags) for c in (F.lit(name), F.col(name).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def series_key(tags: Sequence[str]) -> Column:
    """``tag=value`` pairs in name order; ``concat_ws`` leaves missing tags out."""
    pairs = [F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in sorted(tags)]
    return F.concat_ws(",", *pairs)


def to_long(points: DataFrame, measurement: str | Measurement) -> DataFrame:
    """One row per point and field that has a value."""
    m = measurement if isinstance(measurement, Measurement) else MEASUREMENTS[measurement]
    rows = [
        F.struct(
            F.lit(name).alias("field"),
            (F.col(name).cast("double") if name in m.numbers else F.lit(None).cast("double")).alias("value_num"),
            (F.col(name).cast("string") if name in m.texts else F.lit(None).cast("string")).alias("value_str"),
        )
        for name in m.fields
    ]
    wide = points.select(
        F.lit(m.name.removesuffix("_stream")).alias("measurement"),
        series_key(m.tags).alias("series"), tag_map(m.tags).alias("tags"), "time",
        F.array(*rows).alias("_fields"),
    )
    return (
        wide.select("measurement", "series", "tags", F.inline("_fields"), "time")
        .where(F.col("value_num").isNotNull() | F.col("value_str").isNotNull())
    )


def pivot_fields(
    long: DataFrame, keys: Sequence[str], fields: Sequence[str], texts: Sequence[str] = (),
    aggregate=F.max,
) -> DataFrame:
    """Long to wide: one column per named field, in a single aggregation.

    The field names are given, so no pass over the data has to find them.
    """
    wanted = long.where(F.col("field").isin([*fields, *texts]))
    return wanted.groupBy(*keys).agg(
        *[aggregate(F.when(F.col("field") == f, F.col("value_num"))).alias(f) for f in fields],
        *[F.max(F.when(F.col("field") == f, F.col("value_str"))).alias(f) for f in texts],
    )


# --- upsert -----------------------------------------------------------------------------------

def upsert(
    writes: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str = "ingest_ts",
) -> DataFrame:
    """The state of each point after all writes: per field the last value that is not null.

    ``max_by`` merges map-side, so a point that is written very often stays one row per task.
    Writes of one field with equal ``order`` resolve to the greatest value.
    """
    rank = lambda f: F.struct(F.col(order), F.col(f))
    latest = [
        F.max(F.when(F.col(f).isNotNull(), rank(f)))[f].alias(f) for f in fields
    ]
    return writes.groupBy(*keys).agg(*latest, F.max(order).alias(order))

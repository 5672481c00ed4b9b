"""Grouped and windowed statistics.

The windowed functions take batch and streaming DataFrames alike. A streaming input carries its
watermark; a batch input needs none.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.functions import bins, times
from quakeframe.functions.exact import exact_avg, exact_sum, merge_sum

# Window and slide of each live statistic in seconds, as intended for operation
# and as shortened for a demonstration.
_MIN, _HOUR, _DAY = 60, 3600, 86400
WINDOWS = {
    "intended": {
        "hourly_global": (_HOUR, _HOUR),
        "daily_global": (_DAY, _DAY),
        "rolling_24h": (_DAY, _HOUR),
        "rolling_7day": (7 * _DAY, _DAY),
        "significant": (5 * _MIN, 5 * _MIN),
        "magnitude": (2 * _HOUR, 2 * _HOUR),
        "depth": (12 * _HOUR, 12 * _HOUR),
        "sequence": (30 * _MIN, 30 * _MIN),
    },
    "demo": {
        "hourly_global": (_MIN, _MIN),
        "daily_global": (5 * _MIN, 5 * _MIN),
        "rolling_24h": (5 * _MIN, _MIN),
        "rolling_7day": (10 * _MIN, 5 * _MIN),
        "significant": (30, 30),
        "magnitude": (2 * _MIN, 2 * _MIN),
        "depth": (5 * _MIN, 5 * _MIN),
        "sequence": (30, 30),
    },
}


# --- batch statistics -------------------------------------------------------------------------

def _counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("eq_count")).orderBy(*keys)


def _measured(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("eq_count"), *exact_sum(F.col("mag"), "mag"),
        F.max("mag").alias("max_mag"),
    )
    return grouped.select(
        *keys, "eq_count",
        F.round(exact_avg("mag", F.col("eq_count")), 3).alias("avg_mag"),
        F.round("max_mag", 3).alias("max_mag"),
    ).orderBy(*keys)


def monthly_region_stats(df: DataFrame) -> DataFrame:
    return _measured(df, ["year", "month", "region"])


def weekly_region_stats(df: DataFrame, by_iso_year: bool = False) -> DataFrame:
    """Calendar year with ISO week, so December 30th may be week 1 of its own year.

    With ``by_iso_year`` the year of the week is a key too, which dates the weeks without doubt.
    """
    if not by_iso_year:
        return _measured(df, ["year", "week", "region"])
    dated = df.withColumn("iso_year", times.iso_year(F.col("event_time")))
    return _measured(dated, ["iso_year", "year", "week", "region"])


def daily_global_stats(df: DataFrame) -> DataFrame:
    return _measured(df, ["date"])


def monthly_magnitude_stats(df: DataFrame) -> DataFrame:
    return _counted(df, ["year", "month", "region", "mag_bin"])


def monthly_depth_stats(df: DataFrame) -> DataFrame:
    return _counted(df, ["year", "month", "region", "depth_bin"])


# --- windowed statistics ----------------------------------------------------------------------

def _span() -> list[Column]:
    return [F.min("event_time").alias("min_event_time"), F.max("event_time").alias("max_event_time")]


def _seconds(n: int) -> str:
    return f"{int(n)} seconds"


def _aggregates(measured: bool) -> list[Column]:
    mags = [*exact_sum(F.col("mag"), "mag"), F.max("mag").alias("max_mag")] if measured else []
    return [F.count(F.lit(1)).alias("eq_count"), *mags, *_span()]


def _merges(measured: bool) -> list[Column]:
    mags = [*merge_sum("mag"), F.max("max_mag").alias("max_mag")] if measured else []
    return [
        F.sum("eq_count").alias("eq_count"), *mags,
        F.min("min_event_time").alias("min_event_time"),
        F.max("max_event_time").alias("max_event_time"),
    ]


def _finished(grouped: DataFrame, keys: Sequence[str], measured: bool, *extra: str) -> DataFrame:
    mags = [
        F.round(exact_avg("mag", F.col("eq_count")), 2).alias("avg_mag"),
        F.round("max_mag", 2).alias("max_mag"),
    ] if measured else []
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *keys, "eq_count", *mags, "min_event_time", "max_event_time", *extra,
    )


def tumbling(
    df: DataFrame, keys: Sequence[str], size: int, measured: bool = True, clock: str = "event_time",
) -> DataFrame:
    """Windows of event time or of another ``clock`` column, such as the time of arrival."""
    grouped = df.groupBy(F.window(clock, _seconds(size)), *keys).agg(*_aggregates(measured))
    return _finished(grouped, keys, measured)


def sliding(
    df: DataFrame, keys: Sequence[str], size: int, slide: int, measured: bool = True,
    panes: bool = True, count_panes: bool = False, clock: str = "event_time",
) -> DataFrame:
    """Sliding windows, by default from panes.

    A window of 24 h by 1 h copies each row 24 times. Panes of one slide are aggregated first, so
    only one row per key and pane is copied; integer sums make both forms equal to the last digit.
    """
    if not panes:
        sliding_window = F.window(clock, _seconds(size), _seconds(slide))
        return _finished(df.groupBy(sliding_window, *keys).agg(*_aggregates(measured)), keys, measured)
    pane = F.window(clock, _seconds(gcd(size, slide))).alias("pane")
    paned = df.groupBy(pane, *keys).agg(*_aggregates(measured))
    window = F.window(F.window_time("pane"), _seconds(size), _seconds(slide))
    extra = [F.count(F.lit(1)).alias("n_panes")] if count_panes else []
    merged = paned.groupBy(window, *keys).agg(*_merges(measured), *extra)
    return _finished(merged, keys, measured, *(["n_panes"] if count_panes else []))


def hourly_global(df: DataFrame, durations: str = "intended", clock: str = "event_time") -> DataFrame:
    """No key: partial aggregation leaves one row per window and task for the shuffle."""
    return tumbling(df, [], WINDOWS[durations]["hourly_global"][0], clock=clock)


def daily_global(df: DataFrame, durations: str = "intended", clock: str = "event_time") -> DataFrame:
    return tumbling(df, [], WINDOWS[durations]["daily_global"][0], clock=clock)


def rolling_24h(df: DataFrame, durations: str = "intended", **options) -> DataFrame:
    return sliding(df, ["region"], *WINDOWS[durations]["rolling_24h"], **options)


def rolling_7day(df: DataFrame, durations: str = "intended", **options) -> DataFrame:
    return sliding(df, ["region"], *WINDOWS[durations]["rolling_7day"], **options)


def significant(df: DataFrame) -> DataFrame:
    """Strong events.

    A plain comparison on a stream would move below the watermark, which then would only go on with
    the next strong event, and an alert would wait for it. Comparing pairs gives the same rows but
    uses the event time, so every event moves the watermark.
    """
    if not df.isStreaming:
        return df.where(F.col("mag") >= bins.SIGNIFICANT_FROM)
    least = F.struct(F.lit(bins.SIGNIFICANT_FROM), F.lit("0001-01-01 00:00:00").cast("timestamp"))
    return df.where(F.struct(F.col("mag"), F.col("event_time")) >= least)


def significant_alerts(df: DataFrame, durations: str = "intended", clock: str = "event_time") -> DataFrame:
    out = tumbling(significant(df), ["region"], WINDOWS[durations]["significant"][0], clock=clock)
    return out.withColumn("alert_level", bins.alert_level(F.col("max_mag")))


def magnitude_distribution(df: DataFrame, durations: str = "intended", clock: str = "event_time") -> DataFrame:
    return tumbling(df, ["mag_bin"], WINDOWS[durations]["magnitude"][0], measured=False, clock=clock)


def depth_patterns(df: DataFrame, durations: str = "intended", clock: str = "event_time") -> DataFrame:
    return tumbling(df, ["region", "depth_bin"], WINDOWS[durations]["depth"][0], measured=False, clock=clock)


def sequences(
    df: DataFrame, durations: str = "intended", size: int | None = None,
    min_magnitude: float = 4.0, min_count: int = 3, clock: str = "event_time",
) -> DataFrame:
    """Groups of events in one region and grid cell within a window.

    The class tests the maximum before it is rounded for display. Events without a position
    have no cell and are left out.
    """
    keys = ["region", "lat_grid", "lon_grid"]
    cells = df.where(
        (F.col("mag") >= min_magnitude) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    ).withColumns({
        "lat_grid": bins.grid_cell(F.col("latitude")), "lon_grid": bins.grid_cell(F.col("longitude")),
    })
    window = F.window(clock, _seconds(size or WINDOWS[durations]["sequence"][0]))
    grouped = (
        cells.groupBy(window, *keys).agg(*_aggregates(True))
        .where(F.col("eq_count") >= min_count)
        .withColumn("sequence_type", bins.sequence_type(F.col("eq_count"), F.col("max_mag")))
    )
    return _finished(grouped, keys, True, "sequence_type")


def global_count_range(df: DataFrame) -> DataFrame:
    """Number of events and their first and last time, over the whole input."""
    return df.agg(F.count(F.lit(1)).alias("eq_count"), *_span()).withColumn("region", F.lit("global"))

"""Magnitude and depth bins, grid cells and labels.

The catalogue and the live path differ for negative and missing values, so both forms exist.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Depth bounds in km and magnitude bounds.
SHALLOW_BELOW, INTERMEDIATE_BELOW = 70, 300
SIGNIFICANT_FROM = 6.0
UNKNOWN = "unknown"


def finite(text: Column) -> Column:
    """Text to double; null when it is no number, or none that can be added up (NaN and infinities)."""
    number = text.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def _whole_bin(low: Column) -> Column:
    """Text of the bin of a whole number from zero on, without formatting doubles."""
    return F.concat(low.cast("string"), F.lit(".0-"), low.cast("string"), F.lit(".9"))


def catalogue_magnitude_bin(mag: Column) -> Column:
    low = F.floor(mag)
    negative = F.concat_ws("-", F.round(low.cast("double"), 1), F.round(low.cast("double") + 0.9, 1))
    return F.when(mag >= 0, _whole_bin(low)).otherwise(negative)


def live_magnitude_bin(mag: Column) -> Column:
    return F.when(mag.isNull() | (mag < 0), UNKNOWN).otherwise(_whole_bin(mag.cast("bigint")))


def _depth(depth: Column) -> Column:
    return (
        F.when(depth < SHALLOW_BELOW, "shallow")
        .when(depth < INTERMEDIATE_BELOW, "intermediate")
        .otherwise("deep")
    )


def catalogue_depth_bin(depth: Column) -> Column:
    """Negative depths are shallow."""
    return F.when(depth.isNull(), UNKNOWN).otherwise(_depth(depth))


def live_depth_bin(depth: Column) -> Column:
    """A depth of zero counts as missing, a negative one as unknown."""
    return F.when(depth.isNull() | (depth <= 0), UNKNOWN).otherwise(_depth(depth))


def grid_cell(degrees: Column) -> Column:
    """Index of a 10 degree cell, truncated toward zero."""
    return (degrees / 10).cast("int")


def alert_level(max_mag: Column) -> Column:
    return F.when(max_mag >= 7.0, "critical").when(max_mag >= 6.5, "high").otherwise("moderate")


def panel_alert_level(mag: Column) -> Column:
    return F.when(mag >= 7.0, "CRITICAL").when(mag >= 6.0, "HIGH").otherwise("MEDIUM")


def sequence_type(eq_count: Column, max_mag: Column) -> Column:
    """The order of the tests matters: size first, then strength."""
    return (
        F.when(eq_count < 3, "isolated_sequence")
        .when(eq_count >= 10, "swarm")
        .when(max_mag > 6.0, "aftershock")
        .otherwise("general_sequence")
    )


def depth_label(depth_bin: Column) -> Column:
    known = depth_bin.isin("shallow", "intermediate", "deep")
    return F.when(known, F.initcap(depth_bin)).otherwise(depth_bin)


# Display bands as (lower bound, colour), the first is the base colour.
EVENT_BANDS = [(None, "green"), (5, "yellow"), (7, "red")]
DAILY_COUNT_BANDS = [(None, "green"), (20, "yellow"), (50, "red")]
MAX_MAGNITUDE_BANDS = [(None, "green"), (5, "yellow"), (6, "orange"), (7, "red")]
MAP_BANDS = [(None, "green"), (4, "yellow"), (5, "orange"), (6, "red")]


def band(value: Column, steps: list[tuple[float | None, str]]) -> Column:
    """Colour of the highest bound that the value reaches."""
    out = F.lit(steps[0][1])
    for bound, colour in steps[1:]:
        out = F.when(value >= bound, colour).otherwise(out)
    return F.when(value.isNotNull(), out)


# Text shown for a liveness flag of 0 and 1.
FLAG_TEXTS = {
    "streaming": ("DOWN", "UP"),
    "batch": ("INACTIVE", "ACTIVE"),
    "producer": ("STOPPED", "RUNNING"),
    "store": ("ERROR", "HEALTHY"),
}


def flag_text(flag: Column, panel: str) -> Column:
    off, on = FLAG_TEXTS[panel]
    return F.when(flag == 1, on).otherwise(off)

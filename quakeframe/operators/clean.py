"""Typing, validation, enrichment and deduplication of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.functions import bins, place, times
from quakeframe.schema import CORRUPT, KEPT_FIELDS, LIVE_EVENT
from quakeframe.sources.catalogue import MIN_MAGNITUDE

# Why a message cannot be used though its required fields are there.
PROBLEM = "_problem"

_NUMBERS = ("latitude", "longitude", "depth", "mag")


def type_catalogue(raw: DataFrame) -> DataFrame:
    """Keeps the catalogue columns, casts numbers and parses the time."""
    if "time" not in raw.columns:
        raise ValueError("the catalogue has no 'time' column")
    extra = [F.col("updated")] if "updated" in raw.columns else []
    out = raw.select(*KEPT_FIELDS, *extra)
    parsed = {name: bins.finite(F.col(name)) for name in _NUMBERS}
    parsed["event_time"] = times.parse_catalogue_time(F.col("time"))
    parsed["updated"] = (
        F.coalesce(times.parse_catalogue_time(F.col("updated")), parsed["event_time"])
        if extra else parsed["event_time"]
    )
    return out.withColumns(parsed)


def parse_live(messages: DataFrame) -> DataFrame:
    """JSON messages to typed columns. Bad messages keep their text in ``_corrupt``.

    The fields come out of a generator, below which no filter moves: a filter on a plain projection
    would parse the message once more for each of its tests.
    """
    event = F.from_json("value", LIVE_EVENT, {"columnNameOfCorruptRecord": CORRUPT})
    rest = [c for c in messages.columns if c != "value"]
    fields = messages.select(
        F.col("value").alias("_value"), *[F.col(c).alias(f"_{c}") for c in rest], F.inline(F.array(event)))
    event_time = times.parse_live_time(F.col("time"))
    depth = F.col("depth")
    return fields.select(
        "id",
        event_time.alias("event_time"),
        F.coalesce(times.parse_live_time(F.col("updated")), event_time).alias("updated"),
        *[bins.finite(F.col(name)).alias(name) for name in _NUMBERS],
        "magType", "place", "type", CORRUPT,
        F.when((depth != "") & bins.finite(depth).isNull(), "bad depth").alias(PROBLEM),
        F.col("_value").alias("value"),
        *[F.col(f"_{c}").alias(c) for c in rest],
    )


def message_map(messages: DataFrame) -> DataFrame:
    """All keys of a message as text, for keys outside the schema."""
    return messages.withColumn("entries", F.from_json("value", "map<string,string>"))


def quality_filter(df: DataFrame, min_magnitude: float = MIN_MAGNITUDE) -> DataFrame:
    """``mag >= x`` alone also removes null magnitudes; both tests reach the scan."""
    return df.where(F.col("event_time").isNotNull() & (F.col("mag") >= min_magnitude))


def live_reject_reason(df: DataFrame) -> Column:
    """Why a live event cannot be used, or null. A magnitude of zero counts as missing."""
    reason = (
        F.when(F.coalesce(F.col("id"), F.lit("")) == "", "no id")
        .when(F.col("mag").isNull() | (F.col("mag") == 0), "no magnitude")
        .when(F.col("event_time").isNull(), "no time")
    )
    return reason.otherwise(F.col(PROBLEM)) if PROBLEM in df.columns else reason


def live_required(df: DataFrame, min_magnitude: float = MIN_MAGNITUDE) -> DataFrame:
    """The negation of the reasons, as plain comparisons that reach the scan."""
    mag = F.col("mag")
    usable = (F.col("id") != "") & F.col("event_time").isNotNull() & (mag != 0) & (mag >= min_magnitude)
    return df.where(usable & F.col(PROBLEM).isNull() if PROBLEM in df.columns else usable)


def point_reject_reason() -> Column:
    """Why an event cannot be stored as a point, or null. It still counts in statistics."""
    return (
        F.when(F.col("event_time").isNull(), "no time")
        .when(F.col("mag").isNull(), "no magnitude")
        .when(F.col("latitude").isNull(), "no latitude")
        .when(F.col("longitude").isNull(), "no longitude")
    )


def dead_letters(df: DataFrame, reason: Column) -> DataFrame:
    """The rows that have a reason, with it."""
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def enrich(df: DataFrame, mode: str = "catalog") -> DataFrame:
    """Calendar parts, bins and region by the rules of the ``catalog`` or the ``live`` path."""
    mag, depth, where = F.col("mag"), F.col("depth"), F.col("place")
    if mode == "catalog":
        derived = {
            "mag_bin": bins.catalogue_magnitude_bin(mag),
            "depth_bin": bins.catalogue_depth_bin(depth),
            "region": place.catalogue_region(where),
            "source": F.lit("batch"),
        }
    elif mode == "live":
        derived = {
            "mag_bin": bins.live_magnitude_bin(mag),
            "depth_bin": bins.live_depth_bin(depth),
            "region": place.live_region(where),
            "source": F.lit("stream"),
        }
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumns({**times.calendar_parts(F.col("event_time")), **derived})


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key.

    The filter on ``row_number`` makes Spark keep one row per key and map task before the
    shuffle (WindowGroupLimit), so a key with many copies does not reach one task whole.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def _tie_break(df: DataFrame, used: Sequence[str]) -> list[Column]:
    plain = {"string", "double", "bigint", "int", "timestamp", "date"}
    return [F.col(name).asc_nulls_last() for name, kind in df.dtypes if kind in plain and name not in used]


def dedupe_latest(df: DataFrame, key: str = "id") -> DataFrame:
    """The last update of each event; equal updates are ordered by time, then by all columns."""
    order = [F.col("updated").desc_nulls_last(), F.col("event_time").asc_nulls_last()]
    return _first_by(df, [key], order + _tie_break(df, (key, "updated", "event_time")))


def dedupe_first(df: DataFrame, key: str = "id") -> DataFrame:
    """The first record of each event: the batch form of the streaming deduplication."""
    order = [F.col("event_time").asc_nulls_last()]
    return _first_by(df, [key], order + _tie_break(df, (key, "event_time")))


def catalogue_silver(raw: DataFrame, min_magnitude: float = MIN_MAGNITUDE) -> DataFrame:
    """Raw catalogue to the silver table: type, filter, deduplicate, enrich."""
    return enrich(dedupe_latest(quality_filter(type_catalogue(raw), min_magnitude)), "catalog")

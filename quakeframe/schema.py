"""Schemas of the inputs, the silver table and the measurements."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _D, _L, _I, _TS = (
    T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampType(),
)

# The keys of a catalogue record, all read as text and cast later.
CATALOGUE_FIELDS = [
    "time", "latitude", "longitude", "depth", "mag", "magType", "nst", "gap", "dmin", "rms", "net",
    "id", "updated", "place", "type", "horizontalError", "depthError", "magError", "magNst",
    "status", "locationSource", "magSource",
]
KEPT_FIELDS = ["id", "time", "latitude", "longitude", "depth", "mag", "magType", "place"]

CATALOGUE_CSV = _struct(**{name: _S for name in CATALOGUE_FIELDS})

# Values stay text so that 4.5 and "4.5" both parse; the casts are try_casts.
CORRUPT = "_corrupt"
LIVE_EVENT = _struct(**{name: _S for name in CATALOGUE_FIELDS}, **{CORRUPT: _S})

QUAKES = _struct(
    id=_S, event_time=_TS, updated=_TS, latitude=_D, longitude=_D, depth=_D, mag=_D, magType=_S,
    place=_S, year=_I, month=_I, week=_I, date=T.DateType(), mag_bin=_S, depth_bin=_S, region=_S,
    source=_S,
)

POINT_LONG = _struct(
    measurement=_S, series=_S, tags=T.MapType(_S, _S), field=_S, value_num=_D, value_str=_S, time=_TS,
)

_ALERT = _struct(
    status=_S, startsAt=_S, endsAt=_S,
    labels=T.MapType(_S, _S), annotations=T.MapType(_S, _S),
)
ALERT_PAYLOAD = _struct(
    groupLabels=T.MapType(_S, _S), commonLabels=T.MapType(_S, _S), alerts=T.ArrayType(_ALERT),
)


@dataclass(frozen=True)
class Measurement:
    """Tags identify a series, fields carry values; numeric and text fields are told apart."""

    name: str
    tags: tuple[str, ...]
    numbers: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()

    @property
    def fields(self) -> tuple[str, ...]:
        return self.numbers + self.texts


_MAGS = ("eq_count", "avg_mag", "max_mag")
_SPAN = ("min_event_time", "max_event_time")

# Names, tags and fields of the stored measurements.
MEASUREMENTS = {
    m.name: m
    for m in (
        Measurement("earthquake_events", ("region", "mag_bin", "depth_bin", "source", "mag_type"),
                    ("magnitude", "latitude", "longitude", "depth"), ("event_id", "place")),
        Measurement("daily_global_stats", ("source",), _MAGS),
        Measurement("daily_global_stats_stream", ("region", "source"), _MAGS, _SPAN),
        Measurement("hourly_global_stats", ("region", "source"), _MAGS, _SPAN),
        Measurement("weekly_regional_stats", ("region", "source", "year", "week"), _MAGS),
        Measurement("monthly_regional_stats", ("region", "source", "year", "month"), _MAGS),
        Measurement("monthly_magnitude_stats", ("region", "mag_bin", "source", "year", "month"),
                    ("eq_count",)),
        Measurement("monthly_depth_stats", ("region", "depth_bin", "source", "year", "month"),
                    ("eq_count",)),
        Measurement("rolling_regional_stats", ("region", "window_type", "source"), _MAGS, _SPAN),
        Measurement("significant_event_alerts", ("region", "alert_level", "source"), _MAGS, _SPAN),
        Measurement("realtime_magnitude_distribution", ("mag_bin", "source"), ("eq_count",), _SPAN),
        Measurement("depth_pattern_analysis", ("region", "depth_bin", "source"), ("eq_count",), _SPAN),
        Measurement("sequence_detection", ("region", "sequence_type", "source"),
                    _MAGS + ("lat_grid", "lon_grid"), ("first_event_time", "last_event_time")),
    )
}

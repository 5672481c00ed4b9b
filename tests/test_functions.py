"""Every edge row of the column expressions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quakeframe.functions import bins, place, times


def test_catalogue_time(column):
    values = [
        "1700000000123", "2024-01-02T03:04:05.1Z", "2024-01-02T03:04:05.123Z", "2024-01-02T03:04:05.123456Z",
        "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.123+02", "2024-01-02T03:04:05.123+02:00",
        "2024-01-02T03:04:05.123+0200", "bad", "", None, "99999999999999999999", "12:30", "2024-01-02",
    ]
    day = lambda h, micros: datetime(2024, 1, 2, h, 4, 5, micros)
    assert column(values, "string", times.parse_catalogue_time) == [
        datetime(2023, 11, 14, 22, 13, 20, 123000), day(3, 100000), day(3, 123000), day(3, 123456), day(3, 0),
        day(1, 123000), day(1, 123000), day(1, 123000), None, None, None, None, None, None,
    ]


def test_live_time(column):
    values = ["2024-01-02T03:04:05.1Z", "2024-01-02T03:04:05.123456Z", "2024-01-02T03:04:05Z",
              "2024-01-02T03:04:05.1234567Z", "2024-01-02T03:04:05.1+00:00", "1700000000123", "bad", "", None]
    assert column(values, "string", times.parse_live_time) == [
        datetime(2024, 1, 2, 3, 4, 5, 100000), datetime(2024, 1, 2, 3, 4, 5, 123456)] + [None] * 7


def test_numbers_from_text(column):
    values = ["4.5", "x", "", None, "NaN", "Infinity", "-Infinity", "1e300", "-0.5"]
    assert column(values, "string", bins.finite) == [4.5, None, None, None, None, None, None, 1e300, -0.5]


def test_magnitude_bins(column):
    values = [4.0, 4.95, 10.2, 0.0, -0.5, None]
    assert column(values, "double", bins.catalogue_magnitude_bin) == [
        "4.0-4.9", "4.0-4.9", "10.0-10.9", "0.0-0.9", "-1.0--0.1", ""]
    assert column(values, "double", bins.live_magnitude_bin) == [
        "4.0-4.9", "4.0-4.9", "10.0-10.9", "0.0-0.9", "unknown", "unknown"]


def test_depth_bins(column):
    values = [None, -1.0, 0.0, 69.99, 70.0, 299.99, 300.0]
    rest = ["shallow", "intermediate", "intermediate", "deep"]
    assert column(values, "double", bins.catalogue_depth_bin) == ["unknown", "shallow", "shallow", *rest]
    assert column(values, "double", bins.live_depth_bin) == ["unknown", "unknown", "unknown", *rest]


PLACES = {
    "10 km N of X, Chile": ("Chile", "Chile"),
    "South OF Fiji": ("South OF Fiji", "Fiji"),
    "south of the Fiji Islands region": ("the Fiji Islands", "the Fiji Islands"),
    "north of the south of Peru": ("Peru", "Peru"),
    " region": ("Unknown", "region"),
    "Foo region ": ("Foo region", "Foo"),
    "Foo REGION": ("Foo", "Foo"),
    "Foo,  ": ("Foo,", "Foo,"),
    "a, b of c": ("b of c", "b of c"),
    "a of b of  ": ("a of b of", "a of b of"),
    "proof of": ("proof of", "proof of"),
    "A,region": ("region", "region"),
    "x, Kuril Islands region": ("Kuril Islands", "Kuril Islands"),
    "p,\t Q": ("Q", "Q"),
    " Foo ": (" Foo ", "Foo"),
    "   ": ("Unknown", "Unknown"),
    "": ("Unknown", "Unknown"),
    None: ("Unknown", "Unknown"),
}


def test_regions(column):
    values = list(PLACES)
    assert column(values, "string", place.catalogue_region) == [PLACES[p][0] for p in values]
    assert column(values, "string", place.live_region) == [PLACES[p][1] for p in values]


def test_grid_cells_truncate(column):
    assert column([9.9, -9.9, 10.0, -10.0, 19.9, -19.9, 0.0, None], "double", bins.grid_cell) == [
        0, 0, 1, -1, 1, -1, 0, None]


def test_levels(column):
    values = [5.9, 6.0, 6.49, 6.5, 6.99, 7.0, None]
    assert column(values, "double", bins.alert_level) == [
        "moderate", "moderate", "moderate", "high", "high", "critical", "moderate"]
    assert column(values, "double", bins.panel_alert_level) == [
        "MEDIUM", "HIGH", "HIGH", "HIGH", "HIGH", "CRITICAL", "MEDIUM"]


@pytest.mark.parametrize("top, third", [(6.0, "general_sequence"), (6.1, "aftershock"), (None, "general_sequence")])
def test_sequence_types(column, top, third):
    top = F.lit(top).cast("double")
    assert column([2, 3, 9, 10], "int", lambda v: bins.sequence_type(v, top)) == ["isolated_sequence", third, third, "swarm"]


def test_iso_weeks(column):
    days = [datetime(2024, 12, 30), datetime(2025, 1, 1), datetime(2021, 1, 3), datetime(2026, 12, 31)]
    assert column(days, "timestamp", F.weekofyear) == [1, 1, 53, 53]
    assert column(days, "timestamp", F.year) == [2024, 2025, 2021, 2026]
    assert column(days, "timestamp", times.iso_year) == [2025, 2025, 2020, 2026]
    assert column(days, "timestamp", lambda v: times.iso_week_start(times.iso_year(v), F.weekofyear(v))) == [
        datetime(2024, 12, 30), datetime(2024, 12, 30), datetime(2020, 12, 28), datetime(2026, 12, 28)]
    assert column(days, "timestamp", F.to_date) == [date(d.year, d.month, d.day) for d in days]


def test_bands_and_labels(column):
    assert column([3.9, 4.0, 5.5, 6.0, None], "double", lambda v: bins.band(v, bins.MAP_BANDS)) == [
        "green", "yellow", "orange", "red", None]
    assert column(["shallow", "deep", "unknown"], "string", bins.depth_label) == ["Shallow", "Deep", "unknown"]
    assert column([0, 1], "int", lambda v: bins.flag_text(v, "batch")) == ["INACTIVE", "ACTIVE"]


def test_durations_as_text(column):
    assert column([5.0, 61.9, 3600.0, 90061.0], "double", times.humanize_seconds) == [
        "5s", "1m 1s", "1h 0m 0s", "1d 1h 1m 1s"]

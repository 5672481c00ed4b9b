"""Grouped and windowed statistics."""

from collections import Counter, defaultdict
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quakeframe.operators import clean, statistics
from quakeframe.plans.events import catalogue, live

SF = "/root/testdata/sf0.001"
RELAXED = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
EVENTS = st.lists(
    st.tuples(st.integers(0, 400_000), st.integers(4000, 9000), st.sampled_from(["x, A", "x, B"])), min_size=1, max_size=40)


def build(quake_rows, events):
    rows = [(f"{i}|{p}", float(s), m / 1000) for i, (s, m, p) in enumerate(events)]
    return clean.enrich(quake_rows(rows, place=F.split("id", r"\|")[1]), "live")


def rows(df):
    return sorted(map(tuple, df.collect()))


@settings(**RELAXED)
@given(EVENTS)
def test_panes_equal_direct_windows(quake_rows, events):
    df = build(quake_rows, events)
    assert rows(statistics.rolling_24h(df)) == rows(statistics.rolling_24h(df, panes=False))
    uneven = [statistics.sliding(df, ["region"], 5400, 3600, panes=p) for p in (True, False)]
    assert rows(uneven[0]) == rows(uneven[1])


@settings(**RELAXED)
@given(EVENTS)
def test_bins_add_up(quake_rows, events):
    df = build(quake_rows, events)
    assert sum(r.eq_count for r in statistics.magnitude_distribution(df).collect()) == len(events)
    assert sum(r.eq_count for r in statistics.monthly_depth_stats(df).collect()) == len(events)


@settings(**RELAXED)
@given(EVENTS)
def test_tumbling_windows_against_brute_force(quake_rows, events):
    groups = defaultdict(list)
    for second, mag, _ in events:
        groups[second // 3600].append((second, mag))
    got = {int(r.window_start.timestamp()) // 3600: r for r in statistics.hourly_global(build(quake_rows, events)).collect()}
    assert set(got) == set(groups)
    for hour, members in groups.items():
        row = got[hour]
        assert row.eq_count == len(members)
        assert row.avg_mag == pytest.approx(sum(m for _, m in members) / len(members) / 1000, abs=0.0051)
        assert row.max_mag == pytest.approx(max(m for _, m in members) / 1000, abs=0.0051)
        assert row.max_event_time == datetime.fromtimestamp(max(s for s, _ in members))


def test_average_does_not_depend_on_order(spark):
    """Sums of doubles would differ in the last digits; a tie at the third digit shows it."""
    df = spark.range(0, 30000, 1, 16).select(
        F.lit("r").alias("region"), F.lit(2024).alias("year"), F.lit(1).alias("month"),
        (F.lit(4.0) + (F.col("id") % 2001) / 1000).alias("mag"))
    results = {tuple(statistics.monthly_region_stats(df.orderBy(F.rand(i))).first()) for i in range(4)}
    assert len(results) == 1


def test_rounding_is_half_up(quake_rows):
    df = clean.enrich(quake_rows([("a", 0, 4.0005), ("b", 0, 4.0005)]), "catalog")
    row = statistics.daily_global_stats(df).first()
    assert (row.avg_mag, row.max_mag) == (4.001, 4.001)


def test_sequences(quake_rows):
    lat = F.when(F.col("id").startswith("n"), -5.0).otherwise(5.0)
    spec = [("a1", 0, 4.0), ("a2", 60, 4.1), ("n3", 90, 6.1), ("b1", 1900, 4.0), ("b2", 1901, 3.9), ("b3", 1902, 4.0)]
    df = clean.enrich(quake_rows(spec, latitude=lat), "live")
    found = statistics.sequences(df).collect()
    # Cells of -5 and 5 degrees are the same, and a magnitude of 3.9 is no candidate.
    assert [(r.eq_count, r.lat_grid, r.sequence_type, r.max_mag) for r in found] == [(3, 0, "aftershock", 6.1)]
    lost = clean.enrich(quake_rows(spec, latitude=F.lit(None).cast("double")), "live")
    assert statistics.sequences(lost).count() == 0


def test_week_of_new_year(quake_rows):
    stamps = {"a": datetime(2024, 1, 3), "b": datetime(2024, 12, 30), "c": datetime(2025, 1, 1)}
    df = clean.enrich(quake_rows([(k, v.timestamp(), 4.5) for k, v in stamps.items()]), "catalog")
    plain = {(r.year, r.week): r.eq_count for r in statistics.weekly_region_stats(df).collect()}
    assert plain == {(2024, 1): 2, (2025, 1): 1}
    dated = {(r.iso_year, r.year, r.week): r.eq_count for r in statistics.weekly_region_stats(df, by_iso_year=True).collect()}
    assert dated == {(2024, 2024, 1): 1, (2025, 2024, 1): 1, (2025, 2025, 1): 1}


@pytest.mark.parametrize("durations", ["intended", "demo"])
def test_durations(spark, durations):
    df = live(spark, SF)
    for compute in (statistics.hourly_global, statistics.rolling_7day, statistics.depth_patterns):
        row = compute(df, durations).first()
        name = {"hourly_global": "hourly_global", "rolling_7day": "rolling_7day", "depth_patterns": "depth"}[compute.__name__]
        assert (row.window_end - row.window_start).total_seconds() == statistics.WINDOWS[durations][name][0]


def test_region_counts_add_up(spark):
    df = catalogue(spark, SF)
    total = Counter({"n": df.count()})
    assert sum(r.eq_count for r in statistics.monthly_region_stats(df).collect()) == total["n"]
    assert sum(r.eq_count for r in statistics.monthly_magnitude_stats(df).collect()) == total["n"]

"""Points, their long form, pivots and upserts."""

from datetime import datetime

from pyspark.sql import functions as F

from quakeframe.operators import clean, points, statistics
from quakeframe.schema import MEASUREMENTS


def test_event_points(quake_rows):
    df = clean.enrich(quake_rows([("a", 0, 4.5), ("b", 1, 4.6)], magType=F.lit(""), place=F.lit(None).cast("string"),
                                 latitude=F.when(F.col("id") == "a", 1.0)), "live")
    rows = points.event_points(df).collect()
    assert [(r.event_id, r.region, r.mag_type, r.place) for r in rows] == [("a", "Unknown", None, None)]


def test_long_form_leaves_out_what_is_missing(quake_rows):
    df = clean.enrich(quake_rows([("a", 0, 4.5)], depth=F.lit(None).cast("double"), magType=F.lit("")), "catalog")
    long = points.to_long(points.event_points(df), "earthquake_events").collect()
    assert {r.field for r in long} == {"magnitude", "latitude", "longitude", "event_id", "place"}
    assert {r.series for r in long} == {"depth_bin=unknown,mag_bin=4.0-4.9,region=Chile,source=batch"}
    assert all(set(r.tags) == {"depth_bin", "mag_bin", "region", "source"} for r in long)


def test_pivot_restores_the_wide_form(quake_rows):
    df = points.event_points(clean.enrich(quake_rows([("a", 0, 4.5), ("b", 9, 5.5)]), "catalog"))
    long = points.to_long(df, "earthquake_events")
    wide = points.pivot_fields(long, ["series", "time"], ["magnitude", "depth"], ["event_id"])
    assert sorted((r.event_id, r.magnitude, r.depth) for r in wide.collect()) == [("a", 4.5, 10.0), ("b", 5.5, 10.0)]


def test_all_stat_points_have_their_columns(quake_rows):
    df = clean.enrich(quake_rows([(str(i), i, 6.5) for i in range(3)]), "live")
    shaped = {
        "daily_global_stats": points.daily_points(statistics.daily_global_stats(df)),
        "weekly_regional_stats": points.weekly_points(statistics.weekly_region_stats(df, by_iso_year=True)),
        "monthly_regional_stats": points.monthly_points(statistics.monthly_region_stats(df)),
        "monthly_magnitude_stats": points.monthly_points(statistics.monthly_magnitude_stats(df), "monthly_magnitude_stats"),
        "monthly_depth_stats": points.monthly_points(statistics.monthly_depth_stats(df), "monthly_depth_stats"),
        "hourly_global_stats": points.global_stream_points(statistics.hourly_global(df)),
        "daily_global_stats_stream": points.global_stream_points(statistics.daily_global(df), "daily_global_stats_stream"),
        "rolling_regional_stats": points.rolling_points(statistics.rolling_24h(df), "24h"),
        "significant_event_alerts": points.alert_points(statistics.significant_alerts(df)),
        "realtime_magnitude_distribution": points.stream_points(
            statistics.magnitude_distribution(df), "realtime_magnitude_distribution"),
        "depth_pattern_analysis": points.stream_points(statistics.depth_patterns(df), "depth_pattern_analysis"),
        "sequence_detection": points.sequence_points(statistics.sequences(df)),
    }
    assert set(shaped) | {"earthquake_events"} == set(MEASUREMENTS)
    for name, table in shaped.items():
        m = MEASUREMENTS[name]
        assert table.columns == ["time", *m.tags, *m.fields]
        row = table.first()
        assert row.time == datetime(1969, 12, 29) if "week" in m.tags else row.time == datetime(1970, 1, 1)
        assert row.eq_count >= 1
        assert points.to_long(table, name).count() >= len(m.numbers)


def test_weeks_are_dated_by_their_monday(quake_rows):
    df = clean.enrich(quake_rows([("a", datetime(2024, 12, 30, 5).timestamp(), 4.5)]), "catalog")
    row = points.weekly_points(statistics.weekly_region_stats(df, by_iso_year=True)).first()
    assert (row.time, row.year, row.week) == (datetime(2024, 12, 30), "2024", "1")


def test_upsert_merges_field_by_field(spark):
    writes = spark.createDataFrame(
        [("k", 1, 1.0, "x"), ("k", 2, None, "y"), ("k", 3, 3.0, None), ("m", 5, None, None), ("m", 4, None, "z")],
        "key string, ingest_ts int, a double, b string")
    merged = points.upsert(writes.repartition(3), ["key"], ["a", "b"])
    assert sorted(map(tuple, merged.collect())) == [("k", 3.0, "y", 3), ("m", None, "z", 5)]
    again = points.upsert(merged.unionByName(writes), ["key"], ["a", "b"])
    assert sorted(map(tuple, again.collect())) == [("k", 3.0, "y", 3), ("m", None, "z", 5)]

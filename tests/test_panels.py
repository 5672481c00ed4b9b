"""Dashboard queries on small tables."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quakeframe.operators import buckets, clean, metrics, panels, points

T0 = datetime(2024, 3, 1)


def test_ranges_end_at_the_latest_row(spark):
    df = spark.createDataFrame([(T0 + timedelta(seconds=s),) for s in (0, 60, 299, 300, 360)], "time timestamp")
    assert panels.since(df, mins=5).count() == 4
    assert panels.since(df, F.lit(T0 + timedelta(seconds=60)).cast("timestamp"), mins=5).count() == 2


def test_gaps_are_filled_with_zero(spark):
    days = [("a", 0), ("a", 3), ("b", 1), ("b", 1)]
    df = spark.createDataFrame([(k, T0 + timedelta(days=d, hours=5)) for k, d in days], "k string, time timestamp")
    rows = sorted((r.k, (r.bucket - T0).days, r.n) for r in buckets.calendar_count(df, ["k"]).collect())
    assert rows == [("a", 0, 1), ("a", 1, 0), ("a", 2, 0), ("a", 3, 1), ("b", 1, 2)]
    spine = buckets.spine(spark, F.lit(datetime(2023, 12, 5)).cast("timestamp"), F.lit(T0).cast("timestamp"), "month")
    months = sorted((r.bucket.month, r.n) for r in buckets.calendar_count(df, [], "month", spine).collect())
    assert months == [(1, 0), (2, 0), (3, 4), (12, 0)]


def test_bucket_mean_is_labelled_with_the_end(spark):
    df = spark.createDataFrame([(T0, "a", 1), (T0 + timedelta(hours=3), "a", 4)], "time timestamp, source string, eq_count int")
    row = panels.count_trend(df, "1 day").first()
    assert (row.time, row.value) == (T0 + timedelta(days=1), 2.5)


def test_liveness_without_events(spark):
    df = spark.createDataFrame([(T0, "batch")], "time timestamp, source string")
    as_of = F.lit(T0 + timedelta(hours=12)).cast("timestamp")
    rows = {(r.panel, r.bucket, r.status) for r in panels.source_liveness(df, as_of).collect()}
    assert ("streaming", T0, "DOWN") in rows and ("producer", T0, "RUNNING") in rows
    assert ("batch", datetime(2024, 1, 1), "ACTIVE") in rows and ("batch", datetime(2023, 1, 1), "INACTIVE") in rows


def test_last_value_per_series(spark):
    df = spark.createDataFrame(
        [(T0, "batch", 5), (T0 + timedelta(days=1), "batch", 7), (T0 + timedelta(hours=1), "stream", 9)],
        "time timestamp, source string, eq_count int")
    assert sorted((r.source, r.eq_count) for r in panels.last_value(df, "eq_count").collect()) == [("batch", 7), ("stream", 9)]


def test_strongest_event_ties_go_to_the_latest(quake_rows):
    depth = F.when(F.col("id") == "late", 100.0).otherwise(10.0)
    df = points.event_points(clean.enrich(
        quake_rows([("early", 0, 5.0), ("late", 60, 5.0), ("weak", 90, 4.0)], depth=depth), "live"))
    assert tuple(metrics.recent_strongest(df).first()) == ("Chile", "intermediate", 5.0)
    assert tuple(metrics.recent_count(df).first()) == ("Chile", 3)


def test_snapshot_of_an_empty_hour(quake_rows):
    df = points.event_points(clean.enrich(quake_rows([("a", 0, 5.0)]), "live"))
    stats = df.select("time", "region", F.lit(3).alias("eq_count"), F.lit(5.0).alias("avg_mag"), F.lit(5.0).alias("max_mag"))
    later = F.lit(datetime(1970, 1, 2)).cast("timestamp")
    rows = metrics.snapshot(df, stats, stats, later).collect()
    assert [(r.metric, r.value) for r in rows] == [("max_earthquake_magnitude_24h", 5.0)]
    now = F.lit(datetime(1970, 1, 1, 0, 1)).cast("timestamp")
    assert {r.metric for r in metrics.snapshot(df, stats, stats, now).collect()} == set(metrics._SNAPSHOT)


def test_series_names(spark):
    assert panels.series_names(spark.createDataFrame([(1, 2)], "_valueDeep int, other int")).columns == ["Deep", "other"]


def test_regional_table_with_weighted_average(spark):
    schema = "time timestamp, region string, eq_count bigint, avg_mag double, max_mag double"
    weekly = spark.createDataFrame([(T0, "r", 3, 4.0, 5.0)], schema)
    rolling = spark.createDataFrame([(T0, "r", 1, 6.0, 6.0), (T0, "s", 9, 4.0, 4.0)], schema)
    rows = panels.regional_activity(weekly, rolling).collect()
    assert [(r.region, r.eq_count) for r in rows] == [("s", 9), ("r", 4)]
    assert (rows[1].sum_avg_mag, rows[1].weighted_avg_mag, rows[1].max_mag) == (10.0, 4.5, 6.0)

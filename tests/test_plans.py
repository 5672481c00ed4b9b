"""What the optimizer makes of the operators, and what the library must not contain."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quakeframe.operators import alerts, clean, metrics, points, statistics
from quakeframe.plans import events, registry
from quakeframe.sources import tables

SF = "/root/testdata/sf0.001"
STREAMED = [n for n in registry.QUERIES if n.startswith(("stream_replay", "live_late", "live_restart", "batch_range", "silver_revision", "live_corrected_r"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in STREAMED])
def test_no_python_no_products(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert word not in text


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "quakes")
    events.catalogue(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(silver):
    text = plan(statistics.daily_global(statistics.significant(silver)))
    assert "GreaterThanOrEqual(mag,6.0)" in text
    assert "ReadSchema: struct<event_time:timestamp,mag:double>" in text
    text = plan(clean.live_required(silver).select("id"))
    assert "GreaterThanOrEqual(mag,4.0)" in text and "IsNotNull(event_time)" in text


def test_duplicates_are_dropped_before_the_shuffle(spark):
    text = plan(clean.dedupe_latest(events.quakes(spark, SF, duplicates=True)))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1


def test_statistics_combine_before_the_shuffle(silver):
    text = plan(statistics.rolling_24h(silver))
    assert text.count("HashAggregate") == 4 and "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert plan(statistics.monthly_region_stats(silver)).count("Exchange") == 2  # group and sort


def test_relative_ranges_are_scalar_subqueries(spark):
    text = plan(registry.QUERIES["metric_count_5min"](spark, SF))
    assert "Subquery" in text and "Join" not in text


def test_library_has_no_driver_side_work():
    root = Path(__file__).resolve().parents[1] / "quakeframe"
    for file in root.rglob("*.py"):
        if "llm" in file.parts:  # models and totals of bounded size go to the driver there; its own tests cover them
            continue
        code = file.read_text()
        for pattern in (r"\.collect\(", r"\.toPandas\(", r"\.crossJoin\(", r"\.rdd\b", r"localCheckpoint", r"\budf\(", r"\.toLocalIterator\("):
            assert not re.search(pattern, code), (file.name, pattern)


def test_skewed_region_keeps_its_result(spark):
    """One region with a third of all rows gives the same as a region alone."""
    df = events.catalogue(spark, SF)
    hot = df.withColumn("region", F.when(F.pmod(F.hash("id"), F.lit(3)) == 0, "hot").otherwise(F.col("region")))
    total = hot.where("region = 'hot'").count()
    assert sum(r.eq_count for r in statistics.monthly_region_stats(hot).where("region = 'hot'").collect()) == total


def test_relative_ranges_prune_days(spark, tmp_path):
    stored = str(tmp_path / "points")
    tables.write_by_date(points.event_points(events.live(spark, SF)), stored)
    text = plan(metrics.recent_count(spark.read.parquet(stored)))
    for filters in re.findall(r"PartitionFilters: \[([^\]]*)", text):
        assert "date" in filters
    assert "PartitionFilters: [isnotnull(date" in text and "Subquery" in text
    assert metrics.recent_count(spark.read.parquet(stored)).collect() == metrics.recent_count(
        points.event_points(events.live(spark, SF))).collect()


def test_panels_and_gauges_read_a_table_once(spark):
    from quakeframe.operators import panels

    stored = points.event_points(events.live(spark, SF))
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp")
    counted = stored.selectExpr("*", "length(region) as eq_count", "1.0 as avg_mag", "1.0 as max_mag")
    assert plan(panels.source_liveness(stored, noon)).count("FileScan") == 1
    assert plan(metrics.snapshot(stored, counted, counted, noon)).count("FileScan") == 3


def test_timelines_shuffle_three_times(spark, silver):
    """Once by step, once by day, once for what touches midnight; the days are used twice."""
    stored = points.event_points(silver)
    rule = alerts.RULES["EarthquakeSwarmDetected"]
    for timeline in (metrics.count_timeline(stored), metrics.strongest_timeline(stored, 6.0)):
        found = alerts.firing(timeline, rule)
        found.collect()
        final = plan(found).split("== Initial Plan ==")[0]
        assert final.count("+- Exchange") <= 3  # where nothing touches midnight, the last one is left out


def test_islands_sort_two_rows_a_day(spark):
    """A key with many spells in each day: the shuffle over days has the first and the last of each at most."""
    seconds = F.col("id") * 60  # half a minute of every minute, thirty days; every fourth midnight is bridged
    spells = spark.range(30 * 1440).select(
        F.lit("a").alias("region"), F.timestamp_seconds(seconds).alias("start"), F.timestamp_seconds(seconds + 30).alias("end"), F.lit(1.0).alias("value"))
    bridges = spark.range(8).select(
        F.lit("a").alias("region"), F.timestamp_seconds(F.col("id") * 4 * 86400 - 40).alias("start"), F.timestamp_seconds(F.col("id") * 4 * 86400 + 20).alias("end"), F.lit(2.0).alias("value"))
    rows = spells.unionByName(bridges)
    from quakeframe.operators import buckets

    got = buckets.islands(rows, ["region"], "value")
    found = sorted((r.start.timestamp(), r.end.timestamp(), r.value) for r in got.collect())
    assert len(found) == 30 * 1440 + 8 - 8 - 7  # a bridge joins the spell after midnight and, but for the first, the one before it
    assert all(a[1] < b[0] for a, b in zip(found, found[1:])) and sum(v == 2 for *_, v in found) == 8
    # The shuffle by key alone reads what is left after the filter on midnight.
    assert re.search(r"Exchange hashpartitioning\(region#\d+, \d+\)[^\n]*\n[^\n]*Filter \(\(pmod\(unix_micros\(start", plan(got))

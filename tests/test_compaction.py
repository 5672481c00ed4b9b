"""Live tables by day: compaction beside readers, each row seen once."""

import re

import pytest
from pyspark.sql import functions as F

from quakeframe.operators import metrics, panels, points
from quakeframe.plans.events import live as events
from quakeframe.streaming import compaction, live

SF = "/root/testdata/sf0.001"


@pytest.fixture
def log(spark, tmp_path):
    """The event points in five batches, by id, so that each has rows of most days."""
    rows = live.by_day(points.event_points(events(spark, SF)))

    def put(*batches):
        for batch in batches:
            rows.where(F.col("event_id").cast("int") % 5 == batch).write.mode("overwrite").partitionBy("date").parquet(f"{tmp_path}/log/batch_id={batch}")

    return str(tmp_path / "log"), rows, put


def ids(df):
    return sorted(r.event_id for r in df.collect())


def test_each_row_once_whatever_is_compacted(spark, log):
    path, rows, put = log
    put(0, 1, 2)
    early = compaction.snapshot(spark, path)
    assert (early.version, early.batches) == (None, (0, 1, 2))
    pinned = compaction.read(spark, path, rows.schema)
    first = ids(rows.where("cast(event_id as int) % 5 < 3"))
    assert compaction.compact(spark, path, rows.schema) == 0
    assert ids(pinned) == first == ids(compaction.read(spark, path, rows.schema)) == ids(compaction.read(spark, path, rows.schema, early))
    assert compaction.compact(spark, path, rows.schema) is None  # nothing came since
    put(3)
    assert ids(compaction.read(spark, path, rows.schema)) == ids(rows.where("cast(event_id as int) % 5 < 4"))
    at = compaction.snapshot(spark, path)
    assert at.version == 0 and at.batches == (3,)
    between = compaction.read(spark, path, rows.schema, at)
    assert compaction.compact(spark, path, rows.schema) == 1
    put(4)
    assert ids(compaction.read(spark, path, rows.schema)) == ids(rows)
    assert ids(between) == ids(rows.where("cast(event_id as int) % 5 < 4")) and ids(pinned) == first
    # A compaction that stops before its manifest is written changes nothing; the next one does it again.
    rows.limit(3).write.partitionBy("date").parquet(f"{path}/_days/version=2")
    assert ids(compaction.read(spark, path, rows.schema)) == ids(rows)
    assert compaction.compact(spark, path, rows.schema) == 2
    compaction.expire(spark, path, 1)
    assert compaction.complete(spark, path, "batch_id") == [] and compaction.complete(spark, f"{path}/_manifests", "version") == [2]
    assert ids(compaction.read(spark, path, rows.schema)) == ids(rows)
    files = compaction.read(spark, path, rows.schema).inputFiles()
    assert len(files) == rows.select("date").distinct().count()  # one file a day


def test_only_days_with_new_rows_are_written(spark, log):
    path, rows, put = log
    put(0)
    compaction.compact(spark, path, rows.schema)
    day = rows.agg(F.max("date")).first()[0]
    rows.where((F.col("date") == day) & (F.col("event_id").cast("int") % 5 == 1)).write.partitionBy("date").parquet(f"{path}/batch_id=1")
    assert compaction.compact(spark, path, rows.schema) == 1
    at = compaction.snapshot(spark, path)
    assert {v for d, v in at.days if d != str(day)} == {0} and dict(at.days)[str(day)] == 1
    assert ids(compaction.read(spark, path, rows.schema)) == ids(rows.where((F.col("event_id").cast("int") % 5 == 0) | (F.col("date") == day) & (F.col("event_id").cast("int") % 5 == 1)))


def test_panels_and_gauges_prune_by_date(spark, log):
    path, rows, put = log
    put(0, 1)
    compaction.compact(spark, path, rows.schema)
    put(2, 3, 4)
    table, whole = compaction.read(spark, path, rows.schema), rows.drop("date")
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp")
    for compute in (lambda df: panels.live_feed(df, 50, "2024-01-14", "2024-01-16"), lambda df: metrics.recent_count(df, noon, 500),
                    lambda df: metrics.max_magnitude(df, noon), lambda df: panels.recent_alerts(df, 20, "2024-01-10", "2024-01-12")):
        found = compute(table)
        plan = found._jdf.queryExecution().executedPlan().toString()
        filters = re.findall(r"PartitionFilters: \[([^\]]*)", plan)
        assert len(filters) == 2 and all("date" in f for f in filters)
        assert sorted(map(str, found.collect())) == sorted(map(str, compute(whole).collect()))


def test_nothing_yet(spark, tmp_path):
    schema = live.by_day(points.event_points(events(spark, SF))).schema
    assert compaction.read(spark, str(tmp_path / "none"), schema).count() == 0
    assert compaction.compact(spark, str(tmp_path / "none"), schema) is None
    compaction.expire(spark, str(tmp_path / "none"))


def test_latest_rows_open_the_newest_days(spark, tmp_path):
    """A year of days, with rows of equal time on both sides of midnight and days without rows that count."""
    from quakeframe.sources import tables

    second = F.timestamp_seconds(1704067200 + F.col("day") * 86400 + F.when(F.col("i") < 4, 0).when(F.col("i") < 8, 86399).otherwise(F.col("i") * 600))
    rows = spark.range(366 * 30).select((F.col("id") % 366).alias("day"), F.floor(F.col("id") / 366).alias("i")).select(
        second.alias("time"), F.concat(F.col("day"), F.lit("-"), F.col("i")).alias("event_id"), F.lit("x").alias("place"), F.lit("r").alias("region"),
        F.when((F.col("day") < 300) & (F.col("i") == 3), 6.5).otherwise(4.0).alias("magnitude"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))
    path = str(tmp_path / "year")
    tables.write_by_date(rows, path)
    table, days = spark.read.parquet(path), tables.days_of(spark, path)
    assert len(days) == 366 and days[0] == "2024-12-31"
    for compute, folders in ((lambda df, **o: panels.live_feed(df, 50, **o), 3), (lambda df, **o: panels.live_feed(df, 26, **o), 1),
                             (lambda df, **o: panels.event_map(df, 31, **o), 3), (lambda df, **o: panels.recent_alerts(df, 5, **o), 127)):
        found = compute(table, days=days)
        assert found.collect() == compute(rows).collect()
        scan = found._jdf.queryExecution().executedPlan().toString()
        first = re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= (\d{4}-\d{2}-\d{2})", scan).group(1)
        assert sum(d >= first for d in days) <= folders
    assert panels.recent_alerts(table, 10**6, days=days).count() == panels.recent_alerts(rows, 10**6).count()
    assert panels.live_feed(table.limit(0), 5, days=[]).count() == 0


def test_batches_without_rows(spark, log):
    path, rows, put = log
    rows.limit(0).write.partitionBy("date").parquet(f"{path}/batch_id=0")
    assert compaction.compact(spark, path, rows.schema) == 0
    assert compaction.snapshot(spark, path) == compaction.Snapshot(0, (), ())
    put(1)
    assert compaction.compact(spark, path, rows.schema) == 1
    compaction.expire(spark, path, 1)
    assert ids(compaction.read(spark, path, rows.schema)) == ids(rows.where("cast(event_id as int) % 5 = 1"))

"""Streams give what the batch form gives."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quakeframe.operators import alerts, clean, metrics, points, statistics
from quakeframe.plans.events import live, quakes
from quakeframe.sources.live import read_text_stream
from quakeframe.streaming import hold
from quakeframe.streaming import live as wiring

SF = "/root/testdata/sf0.001"
FLUSH = {"id": "flush", "time": "2034-01-01T00:00:00.000000Z", "mag": 4.0, "place": "__flush__", "latitude": 1, "longitude": 1}


def write_files(folder, batches):
    """Files in time order: their order of arrival is that of modification."""
    folder.mkdir(exist_ok=True)
    start = len(list(folder.iterdir()))
    for i, lines in enumerate(batches, start):
        file = folder / f"{i:04d}.json"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


@pytest.fixture(scope="module")
def lines(spark):
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    df = quakes(spark, SF, duplicates=True).orderBy("event_time").select(F.to_json(F.struct(
        "id", F.date_format("event_time", iso).alias("time"), "latitude", "longitude", "depth", "mag", "magType", "place")))
    return [r[0] for r in df.collect()]


def rows(df):
    return sorted(map(str, df.collect()))


def test_live_job_equals_batch(spark, lines, tmp_path):
    n = len(lines)
    write_files(tmp_path / "in", [lines[: n // 3] + ["broken"], lines[n // 3: 2 * n // 3], lines[2 * n // 3:], [json.dumps(FLUSH)]])
    root = str(tmp_path / "out")
    messages = read_text_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    wiring.run_live(spark, messages, root, str(tmp_path / "checkpoints"), once=True)

    silver = spark.read.parquet(f"{root}/silver").where("region <> '__flush__'")
    assert rows(silver.select("id", "mag", "region")) == rows(live(spark, SF).select("id", "mag", "region"))
    assert [r.reason for r in spark.read.parquet(f"{root}/dead_letters").where("value = 'broken'").collect()] == ["no id"]

    expected = live(spark, SF)
    for name, compute in wiring.STATISTICS.items():
        got = wiring.read_table(spark, root, name).where("coalesce(eq_count, 0) > 0 and time < '2034-01-01'")
        assert rows(got.drop("window", "date")) == rows(wiring.POINTS[name](compute(expected))), name

    wiring.compact_log(spark, f"{root}/earthquake_events", f"{root}/compacted")
    merged, whole = spark.read.parquet(f"{root}/compacted").where("time < '2034-01-01'"), points.event_points(expected)
    assert rows(merged.select(*whole.columns)) == rows(whole)


def test_restart_goes_on_where_it_stopped(spark, lines, tmp_path):
    def run():
        messages = read_text_stream(spark, str(tmp_path / "in"))
        query = wiring.write_files(wiring.silver(messages, delay="1 hour"), f"{tmp_path}/silver", f"{tmp_path}/cp", "date", once=True)
        query.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/silver").count()

    write_files(tmp_path / "in", [lines[:400]])
    first = run()
    write_files(tmp_path / "in", [lines[395:]])  # five messages arrive again
    assert first < run() == live(spark, SF).count()


def test_both_forms_of_deduplication(spark, lines, tmp_path):
    write_files(tmp_path / "in", [lines[:500], lines[500:]])
    for retention in (None, "7 days"):
        messages = read_text_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
        df = wiring.silver(messages, retention=retention)
        wiring.write_files(df, f"{tmp_path}/{retention}", f"{tmp_path}/cp{retention}", once=True).awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/{retention}").count() == live(spark, SF).count()


def test_foreign_output_is_refused(spark, lines, tmp_path):
    write_files(tmp_path / "in", [lines[:50]])
    messages = read_text_stream(spark, str(tmp_path / "in"))
    (tmp_path / "out" / "silver").mkdir(parents=True)
    with pytest.raises(ValueError, match="other checkpoints"):
        wiring.run_live(spark, messages, f"{tmp_path}/out", once=True)


def test_late_events_are_in_silver_and_corrected(spark, tmp_path):
    def event(i, time):
        return json.dumps({**FLUSH, "id": i, "time": time, "place": "x, Chile"})

    write_files(tmp_path / "in", [
        [event("a", "2024-01-01T00:10:00.0Z")], [event("b", "2024-01-01T02:00:00.0Z")], [event("c", "2024-01-01T09:00:00.0Z")],
        [event("late", "2024-01-01T00:20:00.0Z"), event("a", "2024-01-01T10:00:00.0Z")], [event("d", "2024-01-03T00:00:00.0Z")],
    ])
    root = str(tmp_path / "out")
    messages = read_text_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    wiring.write_files(wiring.silver(messages), f"{root}/silver", f"{root}/cp", "date", once=True).awaitTermination()
    silver = spark.read.parquet(f"{root}/silver")
    assert sorted(r.id for r in silver.collect()) == ["a", "b", "c", "d", "late"]
    closed = statistics.hourly_global(silver.where("id not in ('late', 'd')"))
    late = wiring.late_hours(silver, closed)
    assert [r.window_start.hour for r in late.collect()] == [0]
    assert [(r.window_start.hour, r.eq_count) for r in wiring.corrected(silver, late, "hourly_global_stats").collect()] == [(0, 2)]
    assert wiring.corrected(silver, late, "rolling_24h").count() == statistics.rolling_24h(silver).where("window_start < '2024-01-01 01:00:00'").count()


def test_write_log_replaces_a_batch_that_runs_again(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(10).write.parquet(source)
    for attempt in range(2):  # a new checkpoint makes batch 0 run again
        stream = spark.readStream.schema("id bigint").parquet(source)
        wiring.write_log(stream, f"{tmp_path}/log", f"{tmp_path}/cp{attempt}", once=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/log").count() == 10


def test_arrival_stands_in_for_a_missing_time(spark):
    now = datetime(2024, 1, 1)
    df = spark.createDataFrame([(None, now), (now - timedelta(1), now)], "event_time timestamp, timestamp timestamp")
    assert [r.event_time for r in wiring.event_or_arrival(df).collect()] == [now, now - timedelta(1)]


def test_hold_time_on_a_stream_equals_batch(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    ticks = {"a": [0, 15, 30, 45, 120, 135], "b": [15, 60, 75, 90], "flush": [100_000, 200_000]}
    events = sorted((s, k) for k, seconds in ticks.items() for s in seconds)
    schema = "region string, tick timestamp"
    for i, (s, k) in enumerate(events):
        folder = tmp_path / "in"
        spark.createDataFrame([(k, t0 + timedelta(seconds=s))], schema).coalesce(1).write.mode("append").json(str(folder))
        newest = [f for f in folder.glob("*.json") if os.stat(f).st_mtime > 1_750_000_000]
        for f in newest:
            os.utime(f, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    changes = hold.hold_stream(stream, ["region"], 30)
    wiring.write_files(changes, f"{tmp_path}/out", f"{tmp_path}/cp", once=True).awaitTermination()
    got = sorted((r.region, r.state, (r.at - t0).total_seconds()) for r in spark.read.parquet(f"{tmp_path}/out").where("region <> 'flush'").collect())

    spells = spark.createDataFrame(
        [(k, t0 + timedelta(seconds=s), t0 + timedelta(seconds=s + 15), 1.0) for s, k in events if k != "flush"],
        "region string, start timestamp, end timestamp, value double")
    expected = []
    for r in alerts.sustained(spells, ["region"], 30).collect():
        expected.append((r.region, "pending", r.pending_at))
        expected.append((r.region, "resolved" if r.firing_at else "cleared", r.resolved_at))
        if r.firing_at:
            expected.append((r.region, "firing", r.firing_at))
    assert got == sorted((k, s, (t - t0).total_seconds()) for k, s, t in expected)


def test_live_functions_take_streams(spark, tmp_path):
    """Nothing in the windowed statistics needs a batch."""
    stream = spark.readStream.schema(live(spark, SF).schema).parquet(str(tmp_path)).withWatermark("event_time", "30 seconds")
    for name in wiring.STATISTICS:
        assert wiring.POINTS[name](wiring.statistic(stream, name, "demo")).isStreaming
    assert clean.enrich(stream, "live").isStreaming and statistics.significant(stream).isStreaming


def test_windows_of_arrival(spark, tmp_path):
    """By the clock of arrival old events fall into the window of now, whatever their own time."""
    df = live(spark, SF).withColumn("arrival", F.lit(datetime(2030, 1, 1, 0, 30)).cast("timestamp"))
    row = statistics.hourly_global(df, clock="arrival").first()
    assert row.window_start == datetime(2030, 1, 1) and row.eq_count == df.count()
    assert row.max_event_time < datetime(2024, 2, 1)
    stream = spark.readStream.schema(live(spark, SF).schema).parquet(str(tmp_path))
    arrived = wiring.on_arrival(stream)
    assert all(wiring.statistic(arrived, name, "demo", clock="arrival").isStreaming for name in wiring.STATISTICS)


def test_progress_tells_what_was_processed(spark, tmp_path):
    live(spark, SF).write.parquet(f"{tmp_path}/silver")
    table = wiring.read_silver(spark, f"{tmp_path}/silver")
    query = wiring.write_files(wiring.observed(table), f"{tmp_path}/out", f"{tmp_path}/cp", once=True)
    query.awaitTermination()
    seen = [p.observedMetrics["points"] for p in query.recentProgress if "points" in p.observedMetrics]
    assert sum(r.processed for r in seen) == live(spark, SF).count()


def test_kafka_reader_needs_its_connector(spark):
    from pyspark.errors import AnalysisException

    from quakeframe.sources.live import read_kafka

    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_kafka(spark, "localhost:9092", "events")


def test_late_events_are_dropped(spark, tmp_path):
    def event(i, time):
        return json.dumps({**FLUSH, "id": i, "time": time, "place": "x, Chile"})

    write_files(tmp_path / "in", [
        [event("a", "2024-01-01T00:10:00.0Z"), event("b", "2024-01-01T02:00:00.0Z")],
        [event("c", "2024-01-01T01:59:45.0Z")],  # late, but within 30 s
        [event("late", "2024-01-01T00:20:00.0Z")],
        [event("d", "2024-01-01T09:00:00.0Z")],
    ])
    silver = wiring.silver(read_text_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1))
    stats = wiring.statistic(silver, "hourly_global_stats")
    wiring.write_files(stats, f"{tmp_path}/out", f"{tmp_path}/cp", once=True).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("window_start").collect()
    assert [(r.window_start.hour, r.eq_count) for r in got] == [(0, 1), (1, 1), (2, 1)]


def test_swarm_rule_on_a_stream_equals_batch(spark, tmp_path):
    """Counts and hold time chained in one query, against the batch rule."""
    t0 = datetime(2024, 1, 1)
    seconds = {"x, A": [1, 50, 100, 150, 400, 2000, 2001, 2002, 3500], "x, B": [10, 20, 299, 700], "x, flush": [90_000, 180_000]}
    events = sorted((s, p) for p, list_ in seconds.items() for s in list_)

    def line(s, p):
        at = (t0 + timedelta(seconds=s, milliseconds=1)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        return json.dumps({**FLUSH, "id": f"{p}{s}", "time": at, "place": p})

    lines = [line(s, p) for s, p in events]
    write_files(tmp_path / "in", [lines[i: i + 4] for i in range(0, len(lines), 4)])
    silver = wiring.silver(read_text_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1))
    changes = hold.count_rule_stream(silver, hold_seconds=60)
    wiring.write_files(changes, f"{tmp_path}/out", f"{tmp_path}/cp", once=True).awaitTermination()
    got = sorted((r.region, r.state, (r.at - t0).total_seconds()) for r in spark.read.parquet(f"{tmp_path}/out").where("region <> 'flush'").collect())

    batch = clean.enrich(clean.live_required(clean.parse_live(spark.createDataFrame([(x,) for x in lines], "value string"))), "live")
    runs = alerts.sustained(metrics.count_timeline(points.event_points(batch), at_least=3), ["region"], 60).collect()
    expected = [(r.region, "pending", r.pending_at) for r in runs]
    expected += [(r.region, "firing", r.firing_at) for r in runs if r.firing_at]
    expected += [(r.region, "resolved" if r.firing_at else "cleared", r.resolved_at) for r in runs]
    assert got == sorted((k, s, (t - t0).total_seconds()) for k, s, t in expected) and len(got) >= 8

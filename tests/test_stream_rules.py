"""Rules, silences, inhibition and notifications as streams: equal to their batch form, over restarts."""

import os
import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quakeframe.operators import alerts, metrics, points
from quakeframe.plans import alerting
from quakeframe.streaming import live as wiring
from quakeframe.streaming import notices, replay, rules

T0 = datetime(2024, 1, 1)


def at(second):
    return T0 + timedelta(seconds=second)


@pytest.fixture
def stored(quake_rows):
    """Points of two regions: ties in magnitude and time, events on an instant, labels that change within a run."""
    draw = random.Random(9)
    rows = [(f"e{i}", draw.choice([draw.randrange(0, 9000), 15 * draw.randrange(600)]) + draw.choice([0, 0.001]), draw.choice([4.0, 6.5, 6.5, 7.1])) for i in range(150)]
    rows.append(("last", 20_000, 4.0))
    df = quake_rows(rows, depth=(F.hash("id") % 500).cast("double"))
    from quakeframe.operators.clean import enrich
    where = F.when(F.hash("id") % 2 == 0, "x, Chile").otherwise("x, Peru")
    return points.event_points(enrich(df.withColumn("place", where), "live"))


WATCHES = (
    rules.Watch(alerts.RULES["HighMagnitudeEarthquake"], above=6.0), rules.Watch(alerts.RULES["CriticalMagnitudeEarthquake"], 600, above=7.0),
    rules.Watch(alerts.RULES["EarthquakeSwarmDetected"], at_least=3), rules.Watch(alerts.RULES["RegionalSeismicActivity"], 900, at_least=6, hold_seconds=300),
)


def batch_alerts(df, watch):
    if watch.above is None:
        line, keys = metrics.count_timeline(df, lookback_seconds=watch.lookback_seconds, at_least=watch.at_least), ["region"]
    else:
        line, keys = metrics.strongest_timeline(df, watch.above, watch.lookback_seconds), ["region", "depth_bin"]
    found = alerts.firing(line, watch.rule, keys, watch.hold_seconds)
    return found if "depth_bin" in keys else found.withColumn("depth_bin", F.lit(None).cast("string"))


def test_rules_equal_batch(spark, stored):
    changes = replay.run_in_parts(spark, stored, "time", "rules", lambda df: rules.rule_stream(df.withWatermark("time", "30 seconds"), WATCHES), parts=4)
    got = rules.closed_alerts(changes)
    for watch in WATCHES:
        columns = ["region", "depth_bin", "pending_at", "firing_at", "resolved_at", "ticks", "alertname", "severity"]
        ours = got.where(F.col("alertname") == watch.rule.name)
        theirs = batch_alerts(stored, watch).where(F.col("resolved_at") <= at(19_970))
        for extra in (F.col("peak").cast("double").alias("peak"),):
            a, b = (sorted(map(str, df.select(*columns, extra).collect())) for df in (ours, theirs))
            assert a == b and len(a) > 2, watch
    starts = changes.where("state = 'firing'").groupBy("alertname", "region", "firing_ms").count()
    assert starts.where("count > 1").count() == 0


def spells(spark, rows):
    rows = [(n, r, s, at(a), None if b is None else at(b)) for n, r, s, a, b in rows]
    return spark.createDataFrame(rows, "alertname string, region string, severity string, firing_at timestamp, resolved_at timestamp")


def random_spells(seed, severity, count):
    draw, rows, end = random.Random(seed), [], {}
    for _ in range(count):
        region = draw.choice("ab")
        start = end.get(region, 0) + 15 * draw.randrange(1, 40)
        end[region] = start + 15 * draw.randrange(1, 200)
        rows.append(("X", region, severity, start, end[region]))
    return rows


ROUTED = [({"severity": "warning"}, 25, 300), *alerts.ROUTES]


def test_notifications_equal_batch_over_restarts(spark):
    warnings, critical = random_spells(1, "warning", 14), random_spells(2, "critical", 14)
    found = spells(spark, warnings + critical)
    last = max(r[4] for r in warnings + critical)
    got = replay.notified(spark, found, ["region"], ROUTED).where(F.col("sent_at") <= at(last - 30))
    theirs = alerts.notifications(found.where("severity = 'warning'"), found.where("severity = 'critical'"), F.lit(at(last - 30)).cast("timestamp"), ["region"], ROUTED)
    columns = ["alertname", "region", "severity", "firing_at", "status", "repeat", "sent_at"]
    a, b = (sorted(map(str, df.select(*columns).collect())) for df in (got, theirs))
    assert a == b and len(a) > 30
    assert {r.status for r in got.collect()} == {"firing", "resolved"}


def test_inhibition_takes_parts_back(spark):
    targets, sources = spells(spark, random_spells(3, "warning", 12)), spells(spark, random_spells(4, "critical", 12)).select("region", "firing_at", "resolved_at")
    sources = sources.unionByName(sources)  # a source twice mutes once
    got = replay.inhibited(spark, targets, sources, ["region"])
    theirs = alerts.inhibit(targets, sources, ["region"])
    columns = ["alertname", "region", "severity", "firing_at", "tick"]
    a, b = (sorted(map(str, alerts.part_ticks(df).select(*columns).collect())) for df in (got, theirs))
    assert a == b and len(a) > 100


def test_log_of_inhibition_has_retractions(spark, tmp_path):
    targets = spells(spark, [("X", "a", "warning", 0, 600), ("X", "b", "warning", 0, 60)])
    sources = spells(spark, [("Y", "a", "critical", 120, 300)])
    targets.write.parquet(f"{tmp_path}/t")
    sources.limit(0).write.parquet(f"{tmp_path}/s")
    for late in (None, sources):
        if late is not None:
            late.write.mode("append").parquet(f"{tmp_path}/s")
        stream = lambda name: spark.readStream.schema(targets.schema).parquet(f"{tmp_path}/{name}").withWatermark("resolved_at", "1 day")
        with replay.state_settings(spark):
            log = notices.inhibition_stream(stream("t"), stream("s").select("region", "firing_at", "resolved_at"), ["region"], 86400)
            wiring.write_files(log, f"{tmp_path}/out", f"{tmp_path}/cp", once=True).awaitTermination()
    log = spark.read.parquet(f"{tmp_path}/out")
    got = sorted((r.change, r.region, int((r.part_start - T0).total_seconds()), int((r.part_end - T0).total_seconds())) for r in log.collect())
    assert got == [(-1, "a", 0, 600), (1, "a", 0, 120), (1, "a", 0, 600), (1, "a", 300, 600), (1, "b", 0, 60)]
    assert notices.net_parts(log).count() == 3


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    getExpiryTimeInMs = getCurrentProcessingTimeInMs


class Handle:
    """State and timers of one key, in memory."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_silence_by_a_clock_set_by_hand():
    import pandas as pd

    processor, handle, said = rules._Silence(alerts.RULES["SeismicDataPipelineDown"], 300_000, 120_000), Handle(), []
    processor.init(handle)

    def pass_until(now):
        for due in sorted(t for t in handle.timers if t <= now):
            handle.timers.discard(due)
            for out in processor.handleExpiredTimer(("s",), Clock(now), Clock(due)):
                said.extend((r.state, r.at_ms, r.last_ms) for r in out.itertuples())

    def event(now):
        for out in processor.handleInputRows(("s",), iter([pd.DataFrame({"source": ["s"]})]), Clock(now)):
            said.extend((r.state, r.at_ms, r.last_ms) for r in out.itertuples())

    event(0)
    event(100_000)
    pass_until(399_999)
    assert said == [] and handle.timers == {400_000}
    pass_until(400_000)
    event(410_000)
    pass_until(709_000)
    assert said == [("pending", 400_000, 100_000), ("cleared", 410_000, 100_000)]
    pass_until(720_000)
    pass_until(900_000)
    pass_until(10**9)
    assert said[2:] == [("pending", 710_000, 410_000), ("firing", 830_000, 410_000)] and handle.timers == set()
    event(10**9 + 5)
    assert said[4:] == [("resolved", 10**9 + 5, 410_000)] and handle.timers == {10**9 + 300_005}
    event(10**9 + 500_000)  # the timers were due, but rows came first
    assert [s for s, _, _ in said[5:]] == ["pending", "firing", "resolved"]


def test_silence_is_told_while_it_lasts(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "source string, n int")
    rows.limit(0).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")

    def said(n, within=60):
        for _ in range(within * 4):
            found = spark.read.schema(rules.SILENCES).parquet(f"{tmp_path}/out").collect() if os.path.isdir(f"{tmp_path}/out") else []
            if len(found) >= n:
                return sorted((r.source, r.state) for r in found)
            time.sleep(0.25)
        raise AssertionError(found)

    with replay.state_settings(spark):
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        query = wiring.write_files(rules.silence_stream(stream, limit_seconds=2, hold_seconds=2), f"{tmp_path}/out", f"{tmp_path}/cp", interval="200 milliseconds")
        try:
            time.sleep(3)
            assert not os.path.isdir(f"{tmp_path}/out") or spark.read.schema(rules.SILENCES).parquet(f"{tmp_path}/out").count() == 0  # no input, no source
            rows.write.mode("append").parquet(f"{tmp_path}/in")
            assert said(4) == [("a", "firing"), ("a", "pending"), ("b", "firing"), ("b", "pending")]  # without any further input
            rows.where("source = 'a'").write.mode("append").parquet(f"{tmp_path}/in")
            assert ("a", "resolved") in said(5)
        finally:
            query.stop()


def test_job(spark, stored, tmp_path):
    """The job over a silver table: changes and notifications equal the batch job's, and go on after a restart."""
    from quakeframe.plans.events import live

    silver = live(spark, "/root/testdata/sf0.001")
    cut = silver.agg(F.percentile_approx(F.unix_micros("event_time"), 0.5).alias("c")).first()["c"]
    root = str(tmp_path)
    for part in (F.unix_micros("event_time") <= cut, F.unix_micros("event_time") > cut):
        silver.where(part).write.mode("append").partitionBy("date").parquet(f"{root}/silver")
        with replay.state_settings(spark):
            alerting.run_rules(spark, root, once=True)
    last = silver.agg(F.max("event_time").alias("t")).first()["t"] - timedelta(seconds=30)
    as_of = F.lit(last.replace(tzinfo=timezone.utc)).cast("timestamp")
    names = ["HighMagnitudeEarthquake", "CriticalMagnitudeEarthquake", "EarthquakeSwarmDetected", "RegionalSeismicActivity"]
    theirs = alerting.raised(silver, as_of).where(F.col("alertname").isin(names) & F.col("resolved_at").isNotNull())
    ours = rules.closed_alerts(spark.read.schema(rules.CHANGES).parquet(f"{root}/alert_changes"))
    columns = ["alertname", "severity", "region", "depth_bin", "pending_at", "firing_at", "resolved_at", "peak"]
    a, b = (sorted(map(str, df.where(F.col("resolved_at") <= last).select(*columns).collect())) for df in (ours, theirs))
    assert a == b and len(a) > 5
    sent = spark.read.parquet(f"{root}/notifications_live")
    assert sent.where("status = 'firing' and repeat = 0").count() >= len(a) - 1 and sent.where("status = 'resolved'").count() > 0

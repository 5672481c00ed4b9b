"""Hold times, timelines and what follows an alert."""

import json
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quakeframe.operators import alerts, buckets, clean, metrics, points

T0 = datetime(2024, 1, 1, 12)
RELAXED = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def spells(spark, *ticks, label="r", value=3.0, day_start=T0):
    rows = [(label, day_start + timedelta(seconds=t), day_start + timedelta(seconds=t + 15), value) for t in ticks]
    return spark.createDataFrame(rows, "region string, start timestamp, end timestamp, value double")


def states(df):
    at = lambda t: None if t is None else (t - T0).total_seconds()
    return sorted((at(r.pending_at), at(r.firing_at), at(r.resolved_at), r.ticks) for r in df.collect())


def test_hold_time(spark):
    hold = lambda *ticks: states(alerts.sustained(spells(spark, *ticks), ["region"], 30))
    assert hold(0, 15) == [(0, None, 30, 2)]  # gone before the hold time
    assert hold(0, 15, 30) == [(0, 30, 45, 3)]  # exactly the hold time
    assert hold(0, 15, 30, 45, 60) == [(0, 30, 75, 5)]
    assert hold(0, 15, 30, 60, 75) == [(0, 30, 45, 3), (60, None, 90, 2)]  # two islands
    assert states(alerts.sustained(spells(spark, 15), ["region"], 0)) == [(15, 15, 30, 1)]


def test_changed_label_starts_anew(spark):
    df = spells(spark, 0, 15).unionByName(spells(spark, 30, 45, label="s"))
    assert states(alerts.sustained(df, ["region"], 30)) == [(0, None, 30, 2), (30, None, 60, 2)]


def test_runs_go_on_over_midnight(spark):
    evening = datetime(2024, 1, 1, 23, 59, 30)
    df = spells(spark, 0, 15, 30, 45, day_start=evening)
    row = alerts.sustained(df, ["region"], 45).first()
    assert (row.pending_at, row.firing_at, row.ticks) == (evening, datetime(2024, 1, 2, 0, 0, 15), 4)


def brute_count(seconds, lookback, step, at_least):
    if not seconds:
        return set()
    ticks = range(0, max(seconds) + lookback + 2 * step, step)
    return {t for t in ticks if sum(t - lookback <= s <= t for s in seconds) >= at_least}


@settings(**RELAXED)
@given(st.lists(st.integers(86_000, 87_500), min_size=1, max_size=25), st.sampled_from([300, 50]), st.integers(1, 3))
def test_count_timeline_against_brute_force(spark, seconds, lookback, at_least):
    """The events lie around midnight, where the timeline is cut."""
    df = spark.createDataFrame([(s,) for s in seconds], "s int").select(
        F.lit("r").alias("region"), F.timestamp_seconds("s").alias("time"))
    timeline = metrics.count_timeline(df, lookback_seconds=lookback, at_least=at_least).collect()
    ticks = [t for r in timeline for t in range(int(r.start.timestamp()), int(r.end.timestamp()), 15)]
    assert len(ticks) == len(set(ticks))
    assert set(ticks) == brute_count(seconds, lookback, 15, at_least)
    for r in timeline:
        t = int(r.start.timestamp())
        assert r.value == sum(t - lookback <= s <= t for s in seconds)
    runs = sorted((r.start, r.end) for r in buckets.islands(metrics.count_timeline(
        df, lookback_seconds=lookback, at_least=at_least), ["region"], "value").collect())
    assert all(a[1] < b[0] for a, b in zip(runs, runs[1:]))


def event_points(quake_rows, rows, **columns):
    return points.event_points(clean.enrich(quake_rows(rows, **columns), "live"))


def test_strongest_event_decides_the_labels(quake_rows):
    depth = F.when(F.col("id") == "weak", 10.0).otherwise(500.0)
    df = event_points(quake_rows, [("weak", 0, 6.2), ("strong", 150, 6.5), ("small", 160, 5.0)], depth=depth)
    rows = alerts.firing(metrics.strongest_timeline(df, 6.0), alerts.RULES["HighMagnitudeEarthquake"], ["region", "depth_bin"])
    found = sorted((r.depth_bin, r.pending_at.timestamp(), r.resolved_at.timestamp(), r.peak) for r in rows.collect())
    assert found == [("deep", 150.0, 465.0, 6.5), ("shallow", 0.0, 150.0, 6.2)]


def test_silences_against_brute_force(spark):
    seconds = [0, 10, 299, 300, 601, 86_000, 86_399, 86_400, 90_000, 200_000, 200_300]
    df = spark.createDataFrame([(s,) for s in seconds], "s int").select(F.timestamp_seconds("s").alias("time"))
    rows = sorted((r.pending_at.timestamp() - 300, r.gap_seconds, r.firing_at is not None) for r in alerts.data_gaps(df).collect())
    gaps = [(float(a), float(b - a), b - a >= 420) for a, b in zip(seconds, seconds[1:]) if b - a > 300]
    assert rows == gaps


def test_routes(spark):
    df = spark.createDataFrame(
        [("HighMagnitudeEarthquake", "critical"), ("HighMagnitudeEarthquake", "warning"), ("EarthquakeSwarm", "warning"),
         ("Other", "warning"), ("Other", None)], "alertname string, severity string")
    rows = alerts.route(df).collect()
    assert [(r.group_wait, r.repeat_interval) for r in rows] == [(5, 1800), (0, 900), (30, 7200), (10, 3600), (10, 3600)]


def test_inhibition_and_repeats(spark):
    def alert(name, severity, first, last):
        run = alerts.sustained(spells(spark, *range(first, last, 15)), ["region"], 0)
        return run.withColumns({"alertname": F.lit(name), "severity": F.lit(severity)})

    warning, critical = alert("A", "warning", 0, 120), alert("B", "critical", 30, 60)
    ticks = alerts.inhibit(warning, critical)
    assert alerts.part_ticks(ticks).count() == 8  # other names never inhibit
    kept = alerts.inhibit(warning, critical, ["region"])
    at = lambda df, c: sorted((r[c] - T0).total_seconds() for r in df.collect())
    assert at(alerts.part_ticks(kept), "tick") == [0, 15, 60, 75, 90, 105]
    assert at(alerts.repeat_suppression(ticks, ["alertname"], 45), "sent_at") == [0, 45, 90]
    assert at(alerts.repeat_suppression(kept, ["alertname"], 30), "sent_at") == [0, 60, 90]


def test_groups_count_their_alerts(spark):
    run = alerts.sustained(spells(spark, 0, 60, 120), ["region"], 0).withColumns(
        {"alertname": F.lit("A"), "severity": F.lit("warning")})
    row = alerts.group_alerts(run).first()
    assert (row.n_alerts, row.first_firing_at, row.peak) == (3, T0, 3.0)


def test_payloads(spark):
    full = {"status": "firing", "startsAt": "s", "labels": {"alertname": "A", "severity": "critical", "region": "R"},
            "annotations": {"summary": "S", "description": "D"}}
    bodies = [{"alerts": [full, {"labels": {"severity": "warning"}}]}, {"alerts": []}, {"other": 1}]
    rows = [(json.dumps(b), T0 + timedelta(seconds=i)) for i, b in enumerate(bodies)] + [("not json", T0)]
    flat = alerts.flatten_payloads(spark.createDataFrame(rows, "payload string, received_at timestamp"))
    assert sorted(tuple(r)[1:] for r in flat.collect()) == [
        ("A", "firing", "critical", "R", "S", "D", "s", "N/A"),
        ("Unknown", "Unknown", "warning", "N/A", "N/A", "N/A", "N/A", "N/A")]
    assert tuple(alerts.totals(flat).first()) == (2, 1, 1, T0)
    assert alerts.history(flat, keep=1).count() == 1 and alerts.history(flat, show=1).first().alertname == "A"


def test_descriptions(spark):
    df = spark.createDataFrame([(7.0, "R", "deep"), (6.5, "R", None)], "v double, region string, depth_bin string")
    text = [r[0] for r in df.select(alerts.describe(alerts.RULES["HighMagnitudeEarthquake"], F.col("v"))).collect()]
    assert text == ["Earthquake with magnitude 7 detected in R (depth: deep)",
                    "Earthquake with magnitude 6.5 detected in R (depth: )"]

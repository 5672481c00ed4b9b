"""Gauges that a stream keeps: equal to a snapshot at each of its stops."""

import random
from datetime import timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quakeframe.operators import metrics, points
from quakeframe.operators.clean import enrich
from quakeframe.streaming import gauges, replay


@pytest.fixture
def stored(quake_rows):
    draw, second, rows = random.Random(3), 0.0, []
    for i in range(300):
        second += draw.choice([0, 0.001, 1, 5, 30, 100, 900])
        rows.append((f"e{i}", second, draw.choice([4.0, 4.5, 6.5])))
    rows.append(("far", second + 200_000, 5.0))  # all look-backs are empty but for this one
    where = F.when(F.hash("id") % 2 == 0, "x, Chile").otherwise("x, Peru")
    return points.event_points(enrich(quake_rows(rows, place=where, depth=(F.hash("id") % 500).cast("double")), "live"))


def test_equal_to_a_snapshot_at_each_stop(spark, stored, tmp_path):
    root, sizes, seen, nothing = str(tmp_path), [], set(), stored.selectExpr("*", "1 as eq_count", "1.0 as avg_mag", "1.0 as max_mag").limit(0)
    for stream in replay.arriving(spark, stored, "time", root, 5):
        changes = gauges.gauge_stream(stream.withWatermark("time", "30 seconds"))
        gauges.write_series(changes, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
        came = spark.read.schema(stored.schema).parquet(f"{root}/in")
        last = came.agg(F.max("time").alias("t")).first()["t"]
        clock = last.replace(microsecond=last.microsecond // 1000 * 1000) - timedelta(seconds=30)
        as_of = F.lit(clock.replace(tzinfo=timezone.utc)).cast("timestamp")
        expected = metrics.snapshot(came, nothing, nothing, as_of)
        ours = gauges.read_series(spark, f"{root}/out").drop("at_ms")
        a, b = (sorted(map(str, df.select("metric", "region", "depth_bin", "value").collect())) for df in (ours, expected))
        assert a == b
        sizes.append(len(a))
        seen |= {r.metric for r in ours.select("metric").collect()}
    assert len(seen) == 3 and max(sizes) >= 4 and sizes[-1] == 0  # the last event is beyond the watermark, all others have left
    assert len([f for f in (tmp_path / "out").iterdir() if f.name.startswith("version=")]) <= 3


def test_a_batch_that_runs_again_writes_the_same(spark, stored, tmp_path):
    root = str(tmp_path)
    changes = spark.createDataFrame([("m", "a", None, 1.0, 5), ("m", "b", None, 2.0, 5)], gauges.SERIES)
    changes.write.parquet(f"{root}/in")
    for attempt in range(2):
        stream = spark.readStream.schema(gauges.SERIES).parquet(f"{root}/in")
        gauges.write_series(stream, f"{root}/out", f"{root}/cp{attempt}", once=True).awaitTermination()
    assert gauges.read_series(spark, f"{root}/out").count() == 2


def test_no_series(spark, tmp_path):
    assert gauges.read_series(spark, f"{tmp_path}/none").count() == 0


def test_status_panels_have_zeros_for_units_without_events(spark, quake_rows, tmp_path):
    """Days without events, months of different length; at each stop equal to the batch form."""
    from quakeframe.operators import panels
    from quakeframe.streaming import liveness

    shown = [("live", "stream", "day", {"days": 9}), ("any", None, "month", {"months": 3}), ("none", "else", "day", {"days": 2})]
    texts = dict(panels.bins.FLAG_TEXTS)
    panels.bins.FLAG_TEXTS.update({name: ("off", "on") for name, *_ in shown})
    try:
        seconds = [0.5, 3600, 86400 * 4 + 7, 86400 * 4 + 7.001, 86400 * 30, 86400 * 91 + 5, 86400 * 91 + 100]
        stored = points.event_points(enrich(quake_rows([(f"e{i}", s, 5.0) for i, s in enumerate(seconds)]), "live"))
        root = str(tmp_path)
        for stream in replay.arriving(spark, stored, "time", root, 3):
            changes = liveness.unit_stream(stream.withWatermark("time", "30 seconds"), shown)
            gauges.write_series(changes, f"{root}/out", f"{root}/checkpoint", True, keys=("panel", "bucket_ms"), alive="true").awaitTermination()
            came = spark.read.schema(stored.schema).parquet(f"{root}/in")
            clock = F.lit((came.agg(F.max("time").alias("t")).first()["t"] - timedelta(seconds=30)).replace(tzinfo=timezone.utc)).cast("timestamp")
            ours = liveness.status(gauges.read_series(spark, f"{root}/out", liveness.UNITS), clock, shown)
            theirs = panels.source_liveness(came, clock, shown).where("panel <> 'none'")  # a source that never sent anything isn't known
            assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.select(*ours.columns).collect()))
            assert ours.where("flag = 0").count() > 0
    finally:
        panels.bins.FLAG_TEXTS.clear()
        panels.bins.FLAG_TEXTS.update(texts)


class _Handle:
    """What a processor needs of Spark: one value and timers."""

    def __init__(self):
        self.value, self.longest = None, 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.longest = value, max(self.longest, len(value[0]))

    def clear(self):
        self.value = None

    def registerTimer(self, at):  # noqa: N802
        pass

    deleteTimer = registerTimer  # noqa: N815


class _Clock:
    def __init__(self, millis):
        self.getCurrentWatermarkInMs = lambda: millis


def _played(processor, key, batches, delay):
    """What a key says in each micro-batch, and the most characters that its state had."""
    import pandas as pd

    handle, watermark, said = _Handle(), 0, []
    processor.init(handle)
    for rows in [*batches, batches[-1].iloc[:0]]:
        parts = (rows.iloc[at : at + 100] for at in range(0, len(rows), 100))
        said.append(sorted(map(str, pd.concat(processor.handleInputRows(key, parts, _Clock(watermark))).itertuples(index=False))))
        watermark = max(watermark, int(rows["time_us"].max()) // 1000 - delay) if len(rows) else watermark
    return said, handle.longest


def _batches(number):
    """Two weeks in one micro-batch, out of order, then days and late rows."""
    import numpy as np
    import pandas as pd

    draw, day, batches = np.random.default_rng(number), 86_400_000_000, []
    for low, high, size in ((0.01, 14, 4000), (14, 14.01, 500), (13.9999, 17, 500), (16.9, 17.1, 900), (40, 40, 3)):
        time = draw.integers(int(low * day), int(high * day) + 5000, size) // 500 * 500  # some on one millisecond, some on one instant
        batches.append(pd.DataFrame({
            "time_us": time, "magnitude": draw.choice([3.0, 4.5, 5.0, 6.5, 7.0], size, p=[.5, .3, .15, .04, .01]),
            "event_id": [f"e{i}" for i in draw.integers(0, 99, size)], "depth_bin": draw.choice(["deep", "shallow"], size)}))
    return batches


@pytest.mark.parametrize("number", range(4))
def test_units_with_a_delay_are_the_same_of_a_small_state(number):
    from quakeframe.streaming import liveness

    for unit, back in (("day", {"days": 3}), ("month", {"months": 2}), ("year", {"months": 12})):
        ranges, batches = {"p": (unit, back)}, _batches(number)
        plain, most = _played(liveness._Units(ranges), ("p", 0), batches, 30_000)
        small, least = _played(liveness._Units(ranges, 30_000), ("p", 0), batches, 30_000)
        assert plain == small and any(plain)
        assert least < most / 4


def test_a_panel_is_kept_in_parts(spark, quake_rows, tmp_path):
    """The points of a panel are dealt over several keys; each panel and unit is shown once."""
    from quakeframe.streaming import liveness

    stored = points.event_points(enrich(quake_rows([(f"e{i}", 600.0 * i, 5.0) for i in range(400)]), "live"))
    root = str(tmp_path)
    for stream in replay.arriving(spark, stored, "time", root, 2):
        changes = liveness.unit_stream(stream.withWatermark("time", "30 seconds"), [("any", None, "day", {"days": 9})], "30 seconds")
        gauges.write_series(changes, f"{root}/out", f"{root}/checkpoint", True, keys=("panel", "bucket_ms"), alive="true").awaitTermination()
    kept = gauges.read_series(spark, f"{root}/out", liveness.UNITS)
    days = kept.groupBy("panel", "bucket_ms").agg(F.countDistinct("part").alias("parts"), F.count("last_us").alias("n"), F.max("last_us").alias("last"))
    assert days.where("n > 0 and parts > 4").count() == 3
    clock = 599 * 60_000_000 + 86_400_000_000 * 2
    last = [max((600_000_000 * i for i in range(399) if i // 144 == d)) for d in range(3)]  # the watermark is before the last one
    assert sorted(r["last"] for r in days.where("n > 0").collect()) == last
    shown = liveness.status(kept, F.timestamp_micros(F.lit(clock)), [("streaming", None, "day", {"days": 9})])
    assert shown.count() == 0  # of another panel


@pytest.mark.parametrize("number", range(4))
def test_gauges_with_a_delay_are_the_same_of_a_small_state(number):
    for gauge in gauges.GAUGES:
        rows = [b.assign(enter_ms=-(-b.time_us // 1000), leave_ms=(b.time_us + gauge.lookback_seconds * 1_000_000) // 1000 + 1) for b in _batches(number)]
        plain, most = _played(gauges._LookBack({gauge.metric: gauge}), (gauge.metric, "r"), rows, 30_000)
        small, least = _played(gauges._LookBack({gauge.metric: gauge}, 30_000), (gauge.metric, "r"), rows, 30_000)
        assert plain == small and any(plain)
        assert least < most / 4

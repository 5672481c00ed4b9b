"""Typing, validation and deduplication."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quakeframe.operators import clean

GOOD = {"id": "a", "time": "2024-01-01T00:00:00.5Z", "mag": 4.5, "latitude": 1, "longitude": 2.5,
        "place": "x, Chile", "extra": {"deep": 1}}


def messages(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    return spark.createDataFrame([(t,) for t in texts], "value string").withColumn("timestamp", F.current_timestamp())


def test_live_messages(spark):
    bad = ["not json", {**GOOD, "id": ""}, {k: v for k, v in GOOD.items() if k != "id"},
           {**GOOD, "mag": None}, {**GOOD, "mag": 0}, {**GOOD, "mag": "x"}, {**GOOD, "time": "2024-01-01T00:00:00Z"},
           {**GOOD, "depth": "deep"}]
    df = clean.parse_live(messages(spark, GOOD, {**GOOD, "id": "b", "mag": "5.5"}, *bad))
    kept = clean.live_required(df).orderBy("id").collect()
    assert [(r.id, r.mag, r.latitude) for r in kept] == [("a", 4.5, 1.0), ("b", 5.5, 1.0)]
    reasons = [r.reason for r in clean.dead_letters(df, clean.live_reject_reason(df)).collect()]
    assert sorted(reasons) == ["bad depth"] + ["no id"] * 3 + ["no magnitude"] * 3 + ["no time"]


def test_message_map_keeps_unknown_keys(spark):
    row = clean.message_map(messages(spark, {**GOOD, "gap": 7, "net": None})).first()
    assert row.entries["gap"] == "7" and row.entries["mag"] == "4.5" and row.entries["net"] is None


def test_catalogue_needs_a_time(spark):
    with pytest.raises(ValueError):
        clean.type_catalogue(spark.createDataFrame([("a",)], "id string"))


def test_dedupe_latest_is_deterministic(quake_rows):
    df = quake_rows([("a", 10, 4.0), ("a", 20, 5.0), ("a", 20, 4.5), ("b", 5, 6.0), ("b", 1, 7.0)])
    for parts in (1, 3, 7):
        rows = clean.dedupe_latest(df.repartition(parts)).orderBy("id").collect()
        assert [(r.id, r.mag) for r in rows] == [("a", 4.5), ("b", 6.0)]
    assert [(r.id, r.mag) for r in clean.dedupe_first(df).orderBy("id").collect()] == [("a", 4.0), ("b", 7.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5), st.integers(40, 60)), max_size=20))
def test_dedupe_is_idempotent(quake_rows, rows):
    df = quake_rows([(i, float(s), m / 10) for i, s, m in rows] or [("a", 0.0, 4.0)])
    once = clean.dedupe_latest(df)
    assert sorted(map(tuple, clean.dedupe_latest(once).collect())) == sorted(map(tuple, once.collect()))


def test_modes_differ(quake_rows):
    df = quake_rows([("a", 0, 4.2)], depth=F.lit(-1.0), place=F.lit("South OF Fiji"))
    catalog, live = clean.enrich(df, "catalog").first(), clean.enrich(df, "live").first()
    assert (catalog.depth_bin, catalog.region, catalog.source) == ("shallow", "South OF Fiji", "batch")
    assert (live.depth_bin, live.region, live.source) == ("unknown", "Fiji", "stream")
    with pytest.raises(ValueError):
        clean.enrich(df, "other")


def test_events_without_position_are_dead_letters_of_points(quake_rows):
    df = quake_rows([("a", 0, 4.2)], latitude=F.lit(None).cast("double"))
    assert clean.dead_letters(df, clean.point_reject_reason()).first().reason == "no latitude"


def test_one_id_with_a_third_of_all_rows(spark, quake_rows):
    df = quake_rows([(f"e{i}", i, 4.0) for i in range(200)] + [("hot", i, 5.0) for i in range(100)])
    unique = clean.dedupe_latest(df.repartition(8))
    assert unique.count() == 201
    assert unique.where("id = 'hot'").first().event_time.timestamp() == 99

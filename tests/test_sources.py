"""Files, ranges and the batch job."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quakeframe.operators import clean
from quakeframe.plans import batch
from quakeframe.plans.events import quakes
from quakeframe.schema import CATALOGUE_FIELDS
from quakeframe.sources import catalogue, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def csv(spark, tmp_path_factory):
    """The events as a catalogue CSV, with duplicates and rows that cannot be used."""
    df = quakes(spark, SF, duplicates=True)
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = {c: F.col(c).cast("string") for c in ("latitude", "longitude", "depth")}
    rows = df.withColumns({
        **text, "time": iso, "mag": F.when(F.col("id") == "5", "bad").otherwise(F.col("mag").cast("string")),
        "updated": F.date_format("updated", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
    })
    full = rows.select(*[F.col(c) if c in rows.columns else F.lit("z").alias(c) for c in CATALOGUE_FIELDS])
    path = str(tmp_path_factory.mktemp("csv") / "catalogue")
    tables.write_csv(full, path)
    return path


def test_csv_round_trip(spark, csv):
    raw = catalogue.read_csv(spark, csv)
    assert raw.columns == CATALOGUE_FIELDS and set(dict(raw.dtypes).values()) == {"string"}
    assert catalogue.read_csv(spark, csv, schema=None).count() == raw.count() == quakes(spark, SF, True).count()
    assert clean.type_catalogue(raw).where("mag is null").count() >= 1
    plan = raw.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string>" in plan


def test_single_file_only_on_request(spark, tmp_path):
    df = spark.range(100).repartition(3)
    tables.write_csv(df, str(tmp_path / "many"))
    tables.write_csv(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "many").glob("*.csv"))) == 3 and len(list((tmp_path / "one").glob("*.csv"))) == 1


def test_time_range():
    assert catalogue.time_range("2024-01-01", "2024-01-02") == (datetime(2024, 1, 1), datetime(2024, 1, 2))
    now = datetime(2024, 1, 1, 0, 1)
    assert catalogue.time_range(delta_seconds=60, now=now) == (datetime(2024, 1, 1), now)
    with pytest.raises(ValueError):
        catalogue.time_range()


def test_range_filter_is_half_open_and_prunes(spark, tmp_path):
    df = quakes(spark, SF).select("id", F.col("event_time").alias("time"), "mag")
    tables.write_by_date(df, str(tmp_path / "points"))
    first = df.orderBy("time").first().time
    kept = tables.read_points(spark, str(tmp_path / "points"), first, first.replace(day=3, hour=0, minute=0))
    assert kept.where(F.col("time") == first).count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(time" in plan
    none = tables.read_points(spark, str(tmp_path / "points"), "2023-01-01", first)
    assert none.count() == 0


def test_rewriting_days_leaves_others_alone(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))]
    tables.write_by_date(spark.createDataFrame(rows, "v int, time timestamp"), path)
    tables.write_by_date(spark.createDataFrame([(3, datetime(2024, 1, 2))], "v int, time timestamp"), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]


def test_batch_job(spark, csv, tmp_path):
    out = batch.run_batch(spark, csv, str(tmp_path))
    wanted = quakes(spark, SF).where("mag >= 4.0 and id <> '5'")
    silver = spark.read.parquet(f"{tmp_path}/silver")
    assert silver.count() == wanted.count() == silver.select("id").distinct().count()
    # The later copy of an event is the one that is kept.
    later = silver.where("cast(id as int) % 20 = 0").join(wanted.select("id", F.col("event_time").alias("first")), "id")
    assert {round((r.event_time - r.first).total_seconds()) for r in later.collect()} == {10}
    for name, stats in out.items():
        assert stats.agg(F.sum("eq_count")).first()[0] == silver.count(), name
    letters = spark.read.parquet(f"{tmp_path}/dead_letters").count()
    assert letters == silver.where("latitude is null").count() > 0
    assert spark.read.parquet(f"{tmp_path}/points/earthquake_events").count() == silver.count() - letters
    weekly = spark.read.parquet(f"{tmp_path}/points/weekly_regional_stats")
    assert weekly.agg(F.sum("eq_count")).first()[0] == silver.count()


def test_batch_job_over_a_range(spark, csv, tmp_path):
    batch.build_silver(catalogue.read_csv(spark, csv), str(tmp_path / "s"), "2024-01-05", "2024-01-10", 5.0)
    low, high, mag = spark.read.parquet(str(tmp_path / "s")).selectExpr("min(event_time)", "max(event_time)", "min(mag)").first()
    assert datetime(2024, 1, 5) <= low and high <= datetime(2024, 1, 10) and mag >= 5.0


def test_runs_over_ranges_add_up(spark, csv, tmp_path):
    """Several short runs, one of them twice, leave what one run over all leaves."""
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    batch.run_batch(spark, csv, whole)
    edges = ["2024-01-01T00:00:00", "2024-01-09T11:00:00", "2024-01-09T12:00:00", "2024-02-01T00:00:00"]
    for start, end in [*zip(edges, edges[1:]), (edges[1], edges[2])]:
        batch.run_batch(spark, csv, parts, start, end)
    for table in ("silver", "dead_letters", "points/earthquake_events", "points/daily_global_stats",
                  "points/weekly_regional_stats", "points/monthly_magnitude_stats", "points/monthly_regional_stats"):
        a, b = (spark.read.parquet(f"{root}/{table}") for root in (whole, parts))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect())), table
    # A run without events changes nothing.
    batch.run_batch(spark, csv, parts, "2030-01-01", "2030-01-02")
    assert spark.read.parquet(f"{parts}/silver").count() == spark.read.parquet(f"{whole}/silver").count()


def test_periods(spark):
    from datetime import date

    def spans(day, name):
        days = spark.createDataFrame([(date.fromisoformat(day),)], "date date")
        firsts, every = batch.periods(days, batch.PERIODS[name])
        dates = sorted(r.date for r in every.collect())
        return [r.date for r in firsts.collect()], dates[0], dates[-1], len(dates)

    assert spans("2024-05-01", "monthly_region") == ([date(2024, 5, 1)], date(2024, 5, 1), date(2024, 5, 31), 31)
    assert spans("2024-05-01", "weekly_points") == ([date(2024, 4, 29)], date(2024, 4, 29), date(2024, 5, 5), 7)
    assert spans("2025-01-01", "weekly_points") == ([date(2024, 12, 30)], date(2024, 12, 30), date(2025, 1, 5), 7)
    # Calendar year 2024 with ISO week 1: the first seven days and the last two.
    assert spans("2024-12-31", "weekly_region") == ([date(2024, 1, 1)], date(2024, 1, 1), date(2024, 12, 31), 9)


def test_instants_do_not_depend_on_the_machine(spark, monkeypatch):
    import time
    from datetime import datetime, timezone

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        expected = datetime(2024, 1, 1, tzinfo=timezone.utc)
        low, high = catalogue.time_range("2024-01-01", "2024-01-01T02:00:00+02:00")
        assert low == high == expected.replace(tzinfo=None)
        for value in ("2024-01-01", datetime(2024, 1, 1), expected):
            micros = spark.range(1).select(F.unix_micros(catalogue._instant(value))).first()[0]
            assert micros == int(expected.timestamp()) * 1_000_000
    finally:
        monkeypatch.undo()
        time.tzset()


def test_text_of_any_kind_reaches_the_points(spark, tmp_path):
    rows = [(str(i), "2024-01-01T00:00:00.000Z", "1", "2", "3", "4.5", "mb", "north of A\tB") for i in range(3)]
    rows += [("x", "bad", "1", "2", "3", "5", "mb", "y"), ("y", "2024-01-01T00:00:00.000Z", "1", "2", "3", "?", "mb", "z")]
    from quakeframe.schema import CATALOGUE_FIELDS, KEPT_FIELDS

    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in KEPT_FIELDS))
    df = df.select(*[F.col(c) if c in KEPT_FIELDS else F.lit("z").alias(c) for c in CATALOGUE_FIELDS])
    tables.write_csv(df, str(tmp_path / "in"))
    batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    stored = spark.read.parquet(f"{tmp_path}/out/points/monthly_regional_stats").collect()
    assert [(r.region, r.eq_count) for r in stored] == [("A\tB", 3)]
    letters = spark.read.parquet(f"{tmp_path}/out/unreadable").collect()
    assert sorted((r.id, r.reason) for r in letters) == [("x", "no time"), ("y", "no magnitude")]


def test_malformed_records_are_dead_letters(spark, tmp_path):
    """A short line, a long one and one without an id are rejected; a quoted line break is part of its field."""
    def line(i, **values):
        return ",".join({**{c: "" for c in CATALOGUE_FIELDS}, "time": "2024-01-01T00:00:00.000Z", "mag": "5.0", "id": f"e{i}", "place": f'"{i} km, Chile"', **values}.values())

    short = line(3).split(",")[:5]
    lines = [",".join(CATALOGUE_FIELDS), line(1), line(2, place='"3 km of\nLima, Peru"'), ",".join(short), line(4) + ",x,y", line(5, id=""), line(6, id=""), line(7)]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    (folder / "b.csv").write_text("\n".join([lines[0], line(8), line(9) + ",z"]) + "\n")
    assert catalogue.spans_lines(spark, str(folder)) and not catalogue.spans_lines(spark, str(folder / "b.csv"))
    batch.run_batch(spark, str(folder), f"{tmp_path}/out")
    silver = {r.id: r.place for r in spark.read.parquet(f"{tmp_path}/out/silver").collect()}
    assert silver == {"e1": "1 km, Chile", "e2": "3 km of\nLima, Peru", "e7": "7 km, Chile", "e8": "8 km, Chile"}
    letters = spark.read.parquet(f"{tmp_path}/out/unreadable").collect()
    assert sorted(r.reason for r in letters) == ["malformed"] * 3 + ["no id"] * 2
    found = {r.file.rsplit("/", 1)[1]: r.record for r in letters if r.reason == "malformed" and r.record.startswith(line(9)[:20]) and "e9" in r.record}
    assert found == {"b.csv": line(9) + ",z"}
    assert any(r.record == ",".join(short) for r in letters) and any((r.record or "").endswith(",x,y") for r in letters)
    # Without a line break in quotes files are split; the answer is the same.
    batch.run_batch(spark, str(folder / "b.csv"), f"{tmp_path}/one")
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/one/silver").collect()] == ["e8"]
    assert [(r.reason, r.record) for r in spark.read.parquet(f"{tmp_path}/one/unreadable").collect()] == [("malformed", line(9) + ",z")]

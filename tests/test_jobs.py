"""The command lines."""

import json
from datetime import timedelta

from pyspark.sql import functions as F

from quakeframe.plans import jobs
from quakeframe.plans.events import live, quakes
from quakeframe.schema import CATALOGUE_FIELDS
from quakeframe.sources import tables
from quakeframe.streaming import corrections
from quakeframe.streaming.live import STATISTICS, read_table, shaped

SF = "/root/testdata/sf0.001"


def test_batch_command(spark, tmp_path):
    df = quakes(spark, SF).withColumn("time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    full = df.select(*[F.col(c).cast("string") if c in df.columns else F.lit("z").alias(c) for c in CATALOGUE_FIELDS])
    tables.write_csv(full, str(tmp_path / "in"))
    jobs.main(["batch", "--csv", f"{tmp_path}/in", "--out", f"{tmp_path}/out", "--start", "2024-01-05",
               "--end", "2024-01-12", "--min-magnitude", "5"], spark)
    expected = df.where("mag >= 5 and event_time between '2024-01-05' and '2024-01-12'").count()
    assert spark.read.parquet(f"{tmp_path}/out/silver").count() == expected > 0


def test_options_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("DATA_DELTA_SECONDS", "60")
    monkeypatch.setenv("MIN_MAGNITUDE", "5.5")
    options = jobs.parse(["batch", "--csv", "a", "--out", "b"])
    assert options.last_seconds == 60 and options.min_magnitude == 5.5


def test_live_command(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [json.dumps({"id": str(i), "time": f"2024-01-01T00:0{i}:00.0Z", "mag": 4.5, "place": "x, Chile"}) for i in range(5)]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    jobs.main(["live", "--folder", f"{tmp_path}/in", "--out", f"{tmp_path}/out", "--checkpoints", f"{tmp_path}/cp",
               "--durations", "demo", "--once"], spark)
    assert spark.read.parquet(f"{tmp_path}/out/silver").count() == 5
    # The watermark stands at 03:30, so three of the minutes are closed.
    assert spark.read.parquet(f"{tmp_path}/out/hourly_global_stats").count() == 3


def test_alert_and_correction_commands(spark, tmp_path):
    live(spark, SF).write.parquet(f"{tmp_path}/silver")
    jobs.main(["alerts", "--out", str(tmp_path), "--as-of", "2024-02-15"], spark)
    found = spark.read.parquet(f"{tmp_path}/alerts")
    strong = found.where("alertname = 'HighMagnitudeEarthquake'")
    assert strong.count() > 0 and strong.where("action is null or resolved_at is null").count() == 0
    open_ones = found.where("resolved_at is null").collect()
    assert [r.alertname for r in open_ones] == ["SeismicDataPipelineDown"]  # nothing has come for two weeks
    sent = spark.read.parquet(f"{tmp_path}/notifications")
    told = {r.status: r.n for r in sent.where("alertname = 'HighMagnitudeEarthquake'").groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert told["resolved"] == strong.count() <= told["firing"]


def stored(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_corrections_of_all_statistics(spark, tmp_path):
    """Silver has events that the statistics were closed without; then a window that was open closes; then nothing comes."""
    root, silver = str(tmp_path), live(spark, SF)
    on_time, late = silver.where("cast(id as int) % 9 <> 0"), silver.where("cast(id as int) % 9 = 0")
    end = silver.agg(F.max("event_time")).first()[0]

    def whole(rows, name):
        return shaped(STATISTICS[name](rows), name)

    def over(name, days):
        """The windows that end so many days before the last event."""
        return F.col("window") < end - timedelta(days, corrections.window_of(name)[0])

    def versions():
        return sorted(str(f.relative_to(root)) for f in tmp_path.rglob("*.parquet") if "silver" not in str(f))

    def corrections_of(name):
        folder = tmp_path / "corrected" / name
        return spark.read.schema("window timestamp").parquet(str(folder)).count() if folder.exists() else 0

    on_time.write.parquet(f"{root}/silver")
    for name in STATISTICS:  # the stream has closed what ended two days before the last event
        whole(on_time, name).where(over(name, 2)).write.partitionBy("date").parquet(f"{root}/{name}/batch_id=0")
    jobs.main(["correct", "--out", root], spark)
    assert not any(corrections_of(name) for name in STATISTICS)
    late.write.mode("append").parquet(f"{root}/silver")
    jobs.main(["correct", "--out", root], spark)
    fixed = {name: corrections_of(name) for name in STATISTICS}
    assert sum(n > 0 for n in fixed.values()) >= 6, fixed  # the fixture has few strong events and no sequences of half an hour
    for name in STATISTICS:
        closed = F.col("window") <= read_table(spark, root, name).agg(F.max("window")).scalar()
        assert stored(corrections.read_statistic(spark, root, name)) == stored(whole(silver, name).where(closed)), name
    name = "rolling_24h"  # a day later; these windows were closed without the late events too
    whole(on_time, name).where(~over(name, 2) & over(name, 1)).write.partitionBy("date").parquet(f"{root}/{name}/batch_id=1")
    jobs.main(["compact", "--out", root], spark)
    on_time.limit(1).withColumn("id", F.lit("again")).withColumn("event_time", F.lit(end)).write.mode("append").parquet(f"{root}/silver")
    jobs.main(["correct", "--out", root], spark)
    assert stored(corrections.read_statistic(spark, root, name)) == stored(whole(silver, name).where(over(name, 1)))
    before = versions()
    jobs.main(["correct", "--out", root], spark)
    assert versions() == before

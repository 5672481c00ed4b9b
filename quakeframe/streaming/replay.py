"""The given ``events`` table replayed as a stream, run once to the end of the data."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.operators import points, statistics
from quakeframe.operators.clean import enrich, live_required
from quakeframe.plans.events import EVENTS, quakes, to_quakes
from quakeframe.plans.events import live as live_events
from quakeframe.schema import QUAKES
from quakeframe.session import SETTINGS, prepare, work_dir
from quakeframe.sources.live import read_text_stream
from quakeframe.sources.tables import write_by_date
from quakeframe.streaming import corrections, gauges, hold, live, liveness, notices, rules

PARTITIONS = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def event_stream(spark: SparkSession, sf_dir: str, duplicates: bool = False) -> DataFrame:
    files = prepare(spark).readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return live_required(to_quakes(files, duplicates))


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """State has a fixed number of partitions, which adaptive execution does not merge: one per core.
    It is kept in RocksDB. The caller's settings come back afterwards."""
    wanted = {PARTITIONS: str(spark.sparkContext.defaultParallelism), PROVIDER: SETTINGS[PROVIDER]}
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def run(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Runs a stream until its input is used up and reads what it wrote."""
    root = work_dir(spark, name)
    with state_settings(spark):
        live.write_files(df, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def run_in_parts(
    spark: SparkSession, rows: DataFrame, time: str, name: str, build: Callable[[DataFrame], DataFrame], parts: int = 3,
) -> DataFrame:
    """Runs a stream over ``rows`` that arrive in ``parts`` of about equal size by time, and reads what it wrote.

    The query stops after each part and is started again on its checkpoint before the next, so that its
    state outlives a restart in the midst of whatever goes on.
    """
    root = work_dir(spark, name)
    for stream in arriving(spark, rows, time, root, parts):
        built = build(stream)
        live.write_files(built, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(built.schema).parquet(f"{root}/out")


def arriving(spark: SparkSession, rows: DataFrame, time: str, root: str, parts: int) -> Iterator[DataFrame]:
    """A stream over what has arrived, after each of ``parts`` of the rows by time."""
    staged = f"{root}/rows"
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    at = [i / parts for i in range(1, parts)]
    edges = rows.agg(F.percentile_approx(F.unix_micros(time), at).alias("e")).first()["e"] or [0] * len(at)
    number = sum((F.when(F.unix_micros(time) > edge, 1).otherwise(0) for edge in edges), F.lit(0))
    with state_settings(spark):
        for part in range(parts):
            rows.where(number == part).write.mode("append").parquet(f"{root}/in")
            yield spark.readStream.schema(rows.schema).parquet(f"{root}/in")


def statistic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The windows of a live statistic that the watermark has closed."""
    rows = event_stream(spark, sf_dir).withWatermark("event_time", live.WATERMARK)
    return run(spark, live.statistic(enrich(rows, "live"), name), name)


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich(live.unique(event_stream(spark, sf_dir, duplicates=True)), "live")
    return run(spark, rows.select("id", "mag", "region"), "dedupe")


def _messages(spark: SparkSession, sf_dir: str, folder: str, files: int, order: str) -> DataFrame:
    """The events as JSON messages in several files, by an ``order`` of arrival."""
    time = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    fields = F.struct("id", time.alias("time"), "latitude", "longitude", "depth", "mag", "magType", "place")
    rows = quakes(spark, sf_dir).select(F.to_json(fields).alias("value"), F.expr(order).alias("at"))
    rows.repartitionByRange(files, "at").select("value").write.mode("append").text(folder)
    return read_text_stream(spark, folder, max_files_per_trigger=1)


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ids after messages in any order of arrival, over many micro-batches: days late, most of them."""
    root = work_dir(spark, "late")
    messages = _messages(spark, sf_dir, f"{root}/in", 6, "xxhash64(id)")
    return run(spark, live.silver(messages).select("id", "event_time", "mag"), "late")


def restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ids after two runs over one output, with messages of the first run sent again before the second."""
    root = work_dir(spark, "restart")
    for order in ("if(cast(id as int) % 3 > 0, xxhash64(id), 0)", "xxhash64(id, 1)"):
        messages = _messages(spark, sf_dir, f"{root}/in", 2, order)
        live.write_files(live.silver(messages).select("id", "event_time", "mag"), f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{root}/out")


def corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly statistics when every 10th event comes after the windows have closed: written windows,
    the corrected ones in place of those that lacked events."""
    rows = enrich(live_required(quakes(spark, sf_dir)), "live")
    folder = work_dir(spark, "silver")
    write_by_date(rows, folder, "event_time")
    table = spark.read.schema(QUAKES).parquet(folder)
    written = statistics.hourly_global(table.where("cast(id as int) % 10 <> 3"))
    fixed = live.corrected(table, live.late_hours(table, written), "hourly_global_stats")
    return fixed.unionByName(written.join(fixed, "window_start", "left_anti").select(*fixed.columns))


def corrected_statistic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A statistic as it is read after every tenth event came when all windows were closed: from the files
    that the live job and the correction job write."""
    root = work_dir(spark, "corrected")
    fields = F.struct("id", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"), "latitude", "longitude", "depth", "mag", "magType", "place")
    rows = quakes(spark, sf_dir).select(F.to_json(fields).alias("value"), (F.col("id").cast("int") % 10 == 3).alias("late"))
    with state_settings(spark):
        for late in (False, True):
            rows.where(F.col("late") == late).select("value").write.mode("append").text(f"{root}/in")
            live.run_live(spark, read_text_stream(spark, f"{root}/in"), f"{root}/out", once=True, names=[name])
        corrections.correct(spark, f"{root}/out", names=[name])
    return corrections.read_statistic(spark, f"{root}/out", name)


def swarm_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of state of a count rule: two events in five minutes, held for a minute."""
    rows = enrich(event_stream(spark, sf_dir).withWatermark("event_time", live.WATERMARK), "live")
    return run(spark, hold.count_rule_stream(rows, at_least=2, hold_seconds=60), "swarm")


def rule(spark: SparkSession, sf_dir: str, watch: rules.Watch) -> DataFrame:
    """The alerts of a rule that are over when the watermark stops, from a stream that is restarted twice."""
    stored = points.event_points(live_events(spark, sf_dir))
    changes = run_in_parts(spark, stored, "time", "rule", lambda df: rules.rule_stream(df.withWatermark("time", live.WATERMARK), (watch,)))
    return rules.closed_alerts(changes)


def notified(spark: SparkSession, found: DataFrame, equal: list[str], routes) -> DataFrame:
    """What is sent for warnings, muted by critical alerts, of alerts whose changes come in order in three parts."""
    labels = ["alertname", "region", "severity"]
    both = [notices.changes_of(found.where(F.col("severity") == severity), role, labels)
            for severity, role in (("warning", notices.TARGET), ("critical", notices.SOURCE))]
    sent = run_in_parts(spark, both[0].unionByName(both[1]), "at", "notify", lambda df: notices.notification_stream(
        df.withWatermark("at", live.WATERMARK), equal, labels, routes))
    return sent.select("alertname", "region", "severity", F.timestamp_millis("firing_ms").alias("firing_at"), "status", "repeat",
                       F.timestamp_millis("sent_ms").alias("sent_at"))


def inhibited(spark: SparkSession, targets: DataFrame, sources: DataFrame, equal: list[str]) -> DataFrame:
    """The parts of targets that no source mutes. Sources come half a day after the targets that they mute,
    so that parts which were put out are taken back."""
    rows = targets.withColumn("source", F.lit(False)).unionByName(sources.withColumn("source", F.lit(True)), allowMissingColumns=True)
    rows = rows.withColumn("arrival", F.when(F.col("source"), F.col("resolved_at") + F.expr("interval 12 hours")).otherwise(F.col("resolved_at")))

    def build(df: DataFrame) -> DataFrame:
        side = lambda source: df.where(F.col("source") == source).drop("source", "arrival").withWatermark("resolved_at", "1 day")
        return notices.inhibition_stream(side(False), side(True), equal, 7 * 86400)

    return notices.net_parts(run_in_parts(spark, rows, "arrival", "inhibit", build, parts=5))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gauges over events as they are kept when the watermark stops."""
    root = work_dir(spark, "gauges")
    for stream in arriving(spark, points.event_points(live_events(spark, sf_dir)), "time", root, 3):
        changes = gauges.gauge_stream(stream.withWatermark("time", live.WATERMARK), delay=live.WATERMARK)
        gauges.write_series(changes, f"{root}/out", f"{root}/checkpoint", once=True).awaitTermination()
    return gauges.read_series(spark, f"{root}/out").drop("at_ms")


def status(spark: SparkSession, stored: DataFrame) -> DataFrame:
    """The status panels as they are kept when the watermark stops, which is 30 seconds before the last point."""
    root, keys = work_dir(spark, "units"), ("panel", "bucket_ms")
    for stream in arriving(spark, stored, "time", root, 3):
        changes = liveness.unit_stream(stream.withWatermark("time", live.WATERMARK), delay=live.WATERMARK)
        gauges.write_series(changes, f"{root}/out", f"{root}/checkpoint", True, keys=keys, alive="true").awaitTermination()
    last = spark.read.schema(stored.schema).parquet(f"{root}/rows").agg(F.date_trunc("millisecond", F.max("time")) - F.expr(f"interval {live.WATERMARK}"))
    return liveness.status(gauges.read_series(spark, f"{root}/out", liveness.UNITS), last.scalar())

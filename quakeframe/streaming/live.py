"""Messages to silver to statistics.

Events are parsed and deduplicated once, into a silver table. Each statistic is a query of its own
on that table with its own watermark and checkpoint, so it can be restarted or changed alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quakeframe.operators import clean, points, statistics
from quakeframe.schema import MEASUREMENTS, QUAKES
from quakeframe.sources.catalogue import MIN_MAGNITUDE
from quakeframe.sources.tables import exists, write_by_date
from quakeframe.streaming import compaction

WATERMARK = "30 seconds"

STATISTICS: dict[str, Callable[..., DataFrame]] = {
    "hourly_global_stats": statistics.hourly_global,
    "daily_global_stats": statistics.daily_global,
    "rolling_24h": statistics.rolling_24h,
    "rolling_7day": statistics.rolling_7day,
    "significant_event_alerts": statistics.significant_alerts,
    "realtime_magnitude_distribution": statistics.magnitude_distribution,
    "depth_pattern_analysis": statistics.depth_patterns,
    "sequence_detection": statistics.sequences,
}

POINTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "hourly_global_stats": points.global_stream_points,
    "daily_global_stats": lambda df: points.global_stream_points(df, "daily_global_stats_stream"),
    "rolling_24h": lambda df: points.rolling_points(df, "24h"),
    "rolling_7day": lambda df: points.rolling_points(df, "7day"),
    "significant_event_alerts": points.alert_points,
    "realtime_magnitude_distribution": lambda df: points.stream_points(df, "realtime_magnitude_distribution"),
    "depth_pattern_analysis": lambda df: points.stream_points(df, "depth_pattern_analysis"),
    "sequence_detection": points.sequence_points,
}


def event_or_arrival(df: DataFrame, arrival: str = "timestamp") -> DataFrame:
    """Gives events without a time that of their arrival."""
    return df.withColumn("event_time", F.coalesce("event_time", arrival))


def unique(df: DataFrame, retention: str | None = None, arrival: str = "timestamp") -> DataFrame:
    """The first record of each id, however late its event is: no event time takes part.

    Ids are kept for good, in RocksDB on disk. With a ``retention`` they are forgotten that long
    after their arrival, which bounds the state; an id that comes again later is then a new one.
    """
    if retention is None:
        return df.dropDuplicates(["id"])
    return df.withWatermark(arrival, retention).dropDuplicatesWithinWatermark(["id"])


def silver(
    messages: DataFrame, min_magnitude: float = MIN_MAGNITUDE, delay: str = WATERMARK, retention: str | None = None,
    arrival_for_time: bool = False,
) -> DataFrame:
    """Usable events, each once, late ones included. The watermark is set behind the deduplication,
    for what follows in the same query; writing the table needs none. With ``arrival_for_time`` an
    event whose time cannot be read gets that of its arrival instead of being a dead letter."""
    parsed = clean.parse_live(messages)
    usable = clean.live_required(event_or_arrival(parsed) if arrival_for_time else parsed, min_magnitude)
    rows = clean.enrich(unique(usable, retention), "live").select(*QUAKES.names)
    return rows if retention else rows.withWatermark("event_time", delay)


def rejected(messages: DataFrame, arrival_for_time: bool = False) -> DataFrame:
    """Messages that cannot be used, with the reason and their text."""
    parsed = clean.parse_live(messages)
    parsed = event_or_arrival(parsed) if arrival_for_time else parsed
    return clean.dead_letters(parsed, clean.live_reject_reason(parsed)).select("value", "reason", "timestamp")


def on_arrival(df: DataFrame) -> DataFrame:
    """Adds the time of processing as ``arrival``, to be given as the ``clock`` of a statistic."""
    return df.withColumn("arrival", F.current_timestamp()).withWatermark("arrival", "0 seconds")


def observed(df: DataFrame, name: str = "points") -> DataFrame:
    """Counts rows and notes the latest event of each micro-batch.

    The values appear in the progress of the query under ``observedMetrics``; nothing is run twice.
    """
    return df.observe(name, F.count(F.lit(1)).alias("processed"), F.max("event_time").alias("last_update"))


def read_silver(spark: SparkSession, path: str, delay: str = WATERMARK, files_per_trigger: int = 1000) -> DataFrame:
    table = spark.readStream.schema(QUAKES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return table.withWatermark("event_time", delay)


def statistic(silver_rows: DataFrame, name: str, durations: str = "intended", **options) -> DataFrame:
    return STATISTICS[name](silver_rows, durations, **options)


def write_files(
    df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None, once: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append-only parquet: each window is emitted once, when the watermark has passed it."""
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start(path)


def write_log(df: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = "1 minute") -> StreamingQuery:
    """A log of writes, one folder per micro-batch, with folders by day if rows have a ``date``.

    A batch that is run again after a failure replaces its own folder, so nothing is doubled. To be read by
    ``compaction.read``, or merged field by field by ``points.upsert`` where points are written more than once.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        out = batch.write.mode("overwrite")
        (out.partitionBy("date") if "date" in batch.columns else out).parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(save)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def read_log(
    spark: SparkSession, path: str, measurement: str = "earthquake_events",
    keys: tuple[str, ...] = ("event_id", "source"),
) -> DataFrame:
    """The state of each point after all batches of a log; later batches win field by field."""
    m = MEASUREMENTS[measurement]
    values = [c for c in ("time", *m.tags, *m.fields) if c not in keys]
    return points.upsert(spark.read.parquet(path), list(keys), values, order="batch_id").drop("batch_id")


def compact_log(spark: SparkSession, path: str, target: str) -> None:
    """Writes the state of a log as a table by day, in place of many small files."""
    write_by_date(read_log(spark, path), target)


def by_day(stored: DataFrame) -> DataFrame:
    return stored.withColumn("date", F.to_date("time"))


def shaped(stats: DataFrame, name: str) -> DataFrame:
    """The stored form of a statistic: its points, the start of the window they are of, and their day."""
    return by_day(POINTS[name](stats.withColumn("window", F.col("window_start"))))


def stored_schema(spark: SparkSession, name: str) -> StructType:
    """The columns of a live table."""
    none = spark.createDataFrame([], QUAKES)
    return (by_day(points.event_points(none)) if name == "earthquake_events" else shaped(STATISTICS[name](none), name)).schema


def read_table(spark: SparkSession, root: str, name: str, at: compaction.Snapshot | None = None) -> DataFrame:
    """A live table by day, as it was written: the event points or a statistic. Each row is seen once, whatever is compacted meanwhile."""
    return compaction.read(spark, f"{root}/{name}", stored_schema(spark, name), at)


def compact(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Gathers the small files of all live tables into their days. To be run now and then beside the streams."""
    for name in ("earthquake_events", *STATISTICS):
        if compaction.compact(spark, f"{root}/{name}", stored_schema(spark, name)) is not None:
            compaction.expire(spark, f"{root}/{name}", keep)


def late_hours(silver_rows: DataFrame, hourly: DataFrame) -> DataFrame:
    """Hours that have more events than their closed window counted: ``window_start``.

    ``hourly`` are the global hourly statistics as written. Hours after the last written one are
    open. Both sides are one row per hour.
    """
    counted = silver_rows.groupBy(F.window("event_time", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    stored = hourly.groupBy(F.date_trunc("hour", "min_event_time").alias("window_start")).agg(F.max("eq_count").alias("m"))
    closed = stored.agg(F.max("window_start").alias("last"))
    have = counted.select(F.col("w.start").alias("window_start"), "n").join(stored, "window_start", "left")
    late = have.where((F.col("n") > F.coalesce("m", F.lit(0))) & (F.col("window_start") <= closed.select("last").scalar()))
    return late.select("window_start")


def corrected(
    silver_rows: DataFrame, late: DataFrame, name: str, durations: str = "intended",
) -> DataFrame:
    """All windows of a statistic that hold an event of one of the ``late`` hours, from all events.

    The batch form of the statistic runs over the days that these windows touch, which prunes the
    table by date; the windows that no late hour lies in are left as they were written.
    """
    size, *slides = statistics.WINDOWS[durations][WINDOW_OF[name]]
    slide = slides[0] if slides else size
    reach = F.expr(f"interval {size} seconds")
    days = late.select(F.explode(F.sequence(
        F.to_date(F.col("window_start") - reach), F.to_date(F.col("window_start") + reach + F.expr("interval 1 hour")))).alias("date")).distinct()
    rows = silver_rows.join(F.broadcast(days), "date", "left_semi")  # one row per day of the calendar
    second = F.unix_seconds("window_start")
    first = F.floor((second - size) / slide) * slide + slide  # the windows that overlap the hour, by their start
    starts = late.select(F.explode(F.sequence(first.cast("bigint"), second + 3599, F.lit(slide).cast("bigint"))).alias("s"))
    starts = starts.select(F.timestamp_seconds("s").alias("window_start")).distinct()
    return STATISTICS[name](rows, durations).join(starts, "window_start", "left_semi")


WINDOW_OF = {
    "hourly_global_stats": "hourly_global", "daily_global_stats": "daily_global", "rolling_24h": "rolling_24h",
    "rolling_7day": "rolling_7day", "significant_event_alerts": "significant", "realtime_magnitude_distribution": "magnitude",
    "depth_pattern_analysis": "depth", "sequence_detection": "sequence",
}


def run_live(
    spark: SparkSession, messages: DataFrame, root: str, checkpoints: str | None = None,
    durations: str = "intended", min_magnitude: float = MIN_MAGNITUDE, once: bool = False,
    delay: str = WATERMARK, retention: str | None = None, arrival_for_time: bool = False, names: Sequence[str] | None = None,
) -> list[StreamingQuery]:
    """Starts the silver query, the dead letters, the raw points and all statistics (or those of ``names``).

    With ``once`` the stages run to completion one after the other; otherwise all run side by
    side and the statistics follow the silver table. Checkpoints lie under ``root`` unless another
    folder is given, so a restart goes on where the last run stopped; an output that was written
    under other checkpoints is refused, as batch numbers would begin anew and rows would be lost.
    ``delay`` is how long a window waits for late events. Silver keeps later ones too, and
    ``corrections.correct`` computes the windows that they belong to anew; so points keep the start of their ``window``.
    """
    checkpoints = checkpoints or f"{root}/_checkpoints"
    if exists(spark, f"{root}/silver") and not exists(spark, f"{checkpoints}/silver"):
        raise ValueError(f"{root} was written under other checkpoints than {checkpoints}")
    queries = []

    def launch(query: StreamingQuery) -> None:
        queries.append(query)
        if once:
            query.awaitTermination()

    silver_path = f"{root}/silver"
    rows = silver(messages, min_magnitude, delay, retention, arrival_for_time)
    launch(write_files(rows, silver_path, f"{checkpoints}/silver", "date", once))
    launch(write_files(rejected(messages, arrival_for_time), f"{root}/dead_letters", f"{checkpoints}/dead_letters", None, once))
    table = lambda: read_silver(spark, silver_path, delay)
    launch(write_log(by_day(points.event_points(table())), f"{root}/earthquake_events", f"{checkpoints}/earthquake_events", once))
    for name in names or STATISTICS:
        launch(write_log(shaped(statistic(table(), name, durations), name), f"{root}/{name}", f"{checkpoints}/{name}", once))
    return queries

"""The alert job: rules over the silver table, and what is sent for the alerts they raise."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quakeframe.operators import alerts, metrics, panels, points, statistics
from quakeframe.schema import QUAKES
from quakeframe.session import work_dir
from quakeframe.sources.tables import delete, exists
from quakeframe.streaming import gauges, liveness, notices, rules
from quakeframe.streaming.live import WATERMARK, read_silver, write_files

COLUMNS = ["alertname", "severity", "region", "depth_bin", "pending_at", "firing_at", "resolved_at", "peak"]


def raised(silver: DataFrame, as_of: Column) -> DataFrame:
    """The alerts of all rules as known at ``as_of``, with the same columns; a label that a rule lacks is null."""
    known = silver.where(F.col("event_time") <= as_of)
    stored, rules = points.event_points(known), alerts.RULES
    sequences = points.sequence_points(statistics.sequences(known))
    strongest = lambda name, above: alerts.firing(
        metrics.strongest_timeline(stored, above), rules[name], ["region", "depth_bin"], as_of=as_of)
    counted = lambda name, table, seconds, least: alerts.firing(
        metrics.count_timeline(table, lookback_seconds=seconds, at_least=least), rules[name], as_of=as_of)
    gaps = alerts.data_gaps(stored, as_of=as_of).where("firing_at <= resolved_at or resolved_at is null and firing_at is not null")
    tables = [
        strongest("HighMagnitudeEarthquake", 6.0), strongest("CriticalMagnitudeEarthquake", 7.0),
        counted("EarthquakeSwarmDetected", stored, 300, 3), counted("EarthquakeSequenceActive", sequences, 3600, 1),
        counted("RegionalSeismicActivity", stored, 3600, 11), gaps.withColumn("peak", F.col("gap_seconds")),
    ]
    aligned = [
        t.select(*[
            F.col(c).cast("double") if c == "peak" and c in t.columns else F.col(c) if c in t.columns
            else F.lit(None).cast("string").alias(c) for c in COLUMNS
        ]) for t in tables
    ]
    return reduce(DataFrame.unionByName, aligned)


LABELS = ["alertname", "region", "severity", "depth_bin"]


def run_rules(
    spark: SparkSession, root: str, checkpoints: str | None = None, once: bool = False, delay: str = WATERMARK, interval: str = "15 seconds",
) -> list[StreamingQuery]:
    """Starts the rules over the silver table as streams: changes of alerts, silences, what is sent, and the gauges.

    ``gauges`` is a table with one row per series, ``liveness`` one with a row per calendar unit and part of a
    status panel. ``alert_changes`` has what the rules over events say, ``silences`` what the clock says. Notifications read
    the changes; critical alerts mute warnings of the same name and region. With ``once`` the stages run to
    the end of the table, one after the other, and silences, which need a clock that goes on, are left out.
    """
    checkpoints = checkpoints or f"{root}/_checkpoints"
    queries = []

    def launch(df: DataFrame, name: str) -> None:
        queries.append(write_files(df, f"{root}/{name}", f"{checkpoints}/{name}", None, once, interval))
        if once:
            queries[-1].awaitTermination()

    stored = points.event_points(read_silver(spark, f"{root}/silver", delay))
    if not once:
        launch(rules.silence_stream(stored), "silences")
    status = liveness.unit_stream(stored, [panel for panel in panels.LIVENESS if panel[1] != "batch"], delay)
    for df, name, options in (
        (gauges.gauge_stream(stored, delay=delay), "gauges", {}), (status, "liveness", {"keys": ("panel", "bucket_ms"), "alive": "true"}),
    ):
        queries.append(gauges.write_series(df, f"{root}/{name}", f"{checkpoints}/{name}", once, interval, **options))
        if once:
            queries[-1].awaitTermination()
    launch(rules.rule_stream(stored), "alert_changes")
    if not exists(spark, f"{root}/alert_changes"):  # so that it can be read as a stream before anything fires
        spark.createDataFrame([], rules.CHANGES).write.parquet(f"{root}/alert_changes")
    log = spark.readStream.schema(rules.CHANGES).parquet(f"{root}/alert_changes")
    launch(notices.notification_stream(fired_changes(log).withWatermark("at", delay), labels=LABELS), "notifications_live")
    return queries


def fired_changes(log: DataFrame) -> DataFrame:
    """The beginnings and ends of alerts in a change log, as input of notifications: critical alerts mute
    warnings and are told whatever fires beside them."""
    roles = F.when(F.col("severity") == "critical", F.array(F.lit(notices.SOURCE), F.lit(notices.LOUD))).otherwise(F.array(F.lit(notices.TARGET)))
    both = log.select(*LABELS, "firing_ms", "state", F.timestamp_millis("at_ms").alias("at"), F.explode(roles).alias("role"))
    return both.where(F.when(F.col("role").isNotNull(), F.col("state").isin(notices.ENTERS, notices.LEAVES)))


def run_alerts(spark: SparkSession, root: str, as_of: Column | None = None) -> None:
    """Writes ``alerts`` and ``notifications`` under ``root`` from its silver table, by default as of now.

    Alerts are computed once and read back by the notification chain: critical alerts mute warnings of
    the same name and region, the rest is routed, waits, repeats and is resolved.
    """
    # One instant for all jobs of the run: the clock, read once.
    as_of = F.lit(datetime.now(timezone.utc)) if as_of is None else as_of
    silver = spark.read.schema(QUAKES).parquet(f"{root}/silver")
    staged = work_dir(spark, "alerts")
    alerts.annotations(raised(silver, as_of)).write.parquet(staged)
    found = spark.read.parquet(staged)
    found.write.mode("overwrite").parquet(f"{root}/alerts")
    muted = found.where("severity = 'warning'"), found.where("severity = 'critical'")
    labels = ["alertname", "region", "depth_bin"]
    sent = alerts.notifications(muted[0], muted[1], as_of, labels=labels)
    loud = alerts.notifications(muted[1], muted[1].limit(0), as_of, labels=labels)
    sent.unionByName(loud).write.mode("overwrite").parquet(f"{root}/notifications")
    delete(spark, staged)

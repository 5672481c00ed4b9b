"""Command lines for spark-submit: ``batch`` over a catalogue CSV, ``live`` over a message source.

    spark-submit quakeframe/plans/jobs.py batch --csv IN --out ROOT --start 2024-09-01 --end 2025-08-31
    spark-submit quakeframe/plans/jobs.py live --kafka HOST:PORT --topic NAME --out ROOT --checkpoints DIR
    spark-submit quakeframe/plans/jobs.py rules --out ROOT

Options left out are taken from the environment: START_DATE, END_DATE, DATA_DELTA_SECONDS,
MIN_MAGNITUDE, KAFKA_BOOTSTRAP_SERVERS and KAFKA_TOPICS.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from quakeframe.plans.alerting import run_alerts, run_rules
from quakeframe.plans.batch import run_batch
from quakeframe.session import SETTINGS, prepare
from quakeframe.sources.catalogue import MIN_MAGNITUDE, _instant, time_range
from quakeframe.sources.live import read_kafka, read_text_stream
from quakeframe.streaming.corrections import correct
from quakeframe.streaming.live import WATERMARK, compact, run_live


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    env = os.environ.get
    parser = argparse.ArgumentParser(prog="quakeframe")
    jobs = parser.add_subparsers(dest="job", required=True)
    batch = jobs.add_parser("batch")
    batch.add_argument("--csv", required=True)
    batch.add_argument("--start", default=env("START_DATE"))
    batch.add_argument("--end", default=env("END_DATE"))
    batch.add_argument("--last-seconds", type=int, default=env("DATA_DELTA_SECONDS"))
    batch.add_argument("--preview", type=int, default=0)
    jobs.add_parser("alerts").add_argument("--as-of", help="default: now")
    rules = jobs.add_parser("rules")
    rules.add_argument("--checkpoints", help="default: a folder under --out")
    rules.add_argument("--delay", default=WATERMARK, help="how long rules wait for late events")
    rules.add_argument("--once", action="store_true", help="stop at the end of the table")
    jobs.add_parser("compact").add_argument("--keep", type=int, default=2, help="manifests that stay for readers")
    correction = jobs.add_parser("correct")
    correction.add_argument("--durations", choices=["intended", "demo"], default="intended")
    correction.add_argument("--delay", default=WATERMARK, help="that of the live job")
    live = jobs.add_parser("live")
    live.add_argument("--kafka", default=env("KAFKA_BOOTSTRAP_SERVERS"))
    live.add_argument("--topic", default=env("KAFKA_TOPICS"))
    live.add_argument("--folder", help="JSON lines in place of Kafka")
    live.add_argument("--checkpoints", help="default: a folder under --out")
    live.add_argument("--delay", default=WATERMARK, help="how long windows wait for late events")
    live.add_argument("--arrival-for-time", action="store_true", help="for events without a readable time")
    live.add_argument("--retention", help="how long ids are remembered; default: for good")
    live.add_argument("--durations", choices=["intended", "demo"], default="intended")
    live.add_argument("--once", action="store_true", help="stop when the input is used up")
    for job in jobs.choices.values():
        job.add_argument("--out", required=True)
    for job in (batch, live):
        job.add_argument("--min-magnitude", type=float, default=float(env("MIN_MAGNITUDE", MIN_MAGNITUDE)))
    return parser.parse_args(arguments)


def session() -> SparkSession:
    builder = SparkSession.builder.appName("quakeframe")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    options = parse(arguments)
    spark = spark or session()
    if options.job == "batch":
        if bool(options.start) != bool(options.end):
            raise SystemExit("give --start and --end together, or neither")
        bounded = options.start or options.last_seconds is not None
        start, end = time_range(options.start, options.end, options.last_seconds) if bounded else (None, None)
        run_batch(spark, options.csv, options.out, start, end, options.min_magnitude, options.preview)
        return
    if options.job == "alerts":
        run_alerts(spark, options.out, _instant(options.as_of) if options.as_of else None)
        return
    if options.job == "rules":
        run_rules(spark, options.out, options.checkpoints, options.once, options.delay)
        if not options.once:
            spark.streams.awaitAnyTermination()
        return
    if options.job == "compact":
        compact(spark, options.out, options.keep)
        return
    if options.job == "correct":
        correct(spark, options.out, options.durations, options.delay)
        return
    messages = (
        read_text_stream(spark, options.folder) if options.folder
        else read_kafka(spark, options.kafka, options.topic)
    )
    run_live(
        spark, messages, options.out, options.checkpoints, options.durations, options.min_magnitude, options.once,
        options.delay, options.retention, options.arrival_for_time)
    if not options.once:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()

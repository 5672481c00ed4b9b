"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores. The silver tables are
written first, as the jobs do; statistics, panels and alerts then read them.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from quakeframe.operators import alerts, clean, metrics, panels, points, statistics
from quakeframe.plans import events
from quakeframe.plans.registry import QUERIES
from quakeframe.session import local_session
from quakeframe.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def consume(df) -> None:
    """Runs a query to its end without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    root = tempfile.mkdtemp(prefix="quakeframe-bench-")
    spark = local_session(CPUS, **{"spark.checkpoint.dir": f"{root}/work"})

    def write_silver() -> None:
        unique = clean.dedupe_latest(clean.quality_filter(events.quakes(spark, SF_DIR, duplicates=True)))
        tables.write_by_date(clean.enrich(unique, "catalog"), f"{root}/silver", "event_time")

    def write_live() -> None:
        tables.write_by_date(events.live(spark, SF_DIR), f"{root}/live", "event_time")

    silver = lambda: spark.read.parquet(f"{root}/silver")
    live = lambda: spark.read.parquet(f"{root}/live")
    stored = lambda: points.event_points(live())

    def many() -> None:
        """Each event a hundred times, spread over as many months: ten million rows at sf0.1."""
        rows = live().withColumn("event_time", F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(99)), lambda i: F.timestamp_micros(F.unix_micros("event_time") + i.cast("bigint") * 2_592_000_000_000))))
        rows.select("event_time", "mag", "region").write.mode("overwrite").parquet(f"{root}/many")

    swarm = alerts.RULES["EarthquakeSwarmDetected"]
    timed = {
        "write_silver": write_silver,
        "write_live": write_live,
        "catalog_job_monthly": lambda: consume(QUERIES["catalog_job_monthly"](spark, SF_DIR)),
        "monthly_region_stats": lambda: consume(statistics.monthly_region_stats(silver())),
        "weekly_region_stats": lambda: consume(statistics.weekly_region_stats(silver())),
        "daily_global_stats": lambda: consume(statistics.daily_global_stats(silver())),
        "monthly_magnitude_stats": lambda: consume(statistics.monthly_magnitude_stats(silver())),
        "monthly_depth_stats": lambda: consume(statistics.monthly_depth_stats(silver())),
        "hourly_global_stats": lambda: consume(statistics.hourly_global(live())),
        "rolling_24h_region_panes": lambda: consume(statistics.rolling_24h(live())),
        "rolling_24h_region_direct": lambda: consume(statistics.rolling_24h(live(), panes=False)),
        "rolling_7d_region": lambda: consume(statistics.rolling_7day(live())),
        "rapid_sequence_detection": lambda: consume(statistics.sequences(live(), size=86400)),
        "live_feed_top50": lambda: consume(panels.live_feed(stored())),
        "map_top1000": lambda: consume(panels.event_map(stored())),
        "metric_max_24h": lambda: consume(metrics.max_magnitude(stored())),
        "alert_swarm": lambda: consume(alerts.firing(metrics.count_timeline(stored(), at_least=2), swarm)),
        "alert_high_magnitude": lambda: consume(QUERIES["alert_high_magnitude"](spark, SF_DIR)),
        "source_liveness": lambda: consume(QUERIES["source_liveness"](spark, SF_DIR)),
        "metrics_snapshot": lambda: consume(QUERIES["metrics_snapshot"](spark, SF_DIR)),
        "alert_data_gap": lambda: consume(alerts.data_gaps(stored())),
        "stream_replay_rolling_24h": lambda: consume(QUERIES["stream_replay_rolling_24h"](spark, SF_DIR)),
        "stream_replay_dedupe": lambda: consume(QUERIES["stream_replay_dedupe"](spark, SF_DIR)),
    }
    seconds = {}
    for name, run in timed.items():
        runs = []
        for _ in range(2):  # the first run compiles
            begin = time.perf_counter()
            run()
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(min(runs), 3)
    many()
    for name, panes in (("rolling_24h_panes_100x", True), ("rolling_24h_direct_100x", False)):
        begin = time.perf_counter()
        consume(statistics.rolling_24h(spark.read.parquet(f"{root}/many"), panes=panes))
        seconds[name] = round(time.perf_counter() - begin, 3)
    events_read = events.read_events(spark, SF_DIR).count()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "events": events_read, "cpus": CPUS,
        "replay_rows_per_sec": round(events_read / seconds["stream_replay_rolling_24h"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

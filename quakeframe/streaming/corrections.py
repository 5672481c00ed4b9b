"""Windows that late events have made wrong: computed anew as higher versions, merged when read.

A statistic's table (``live.run_live``) gets each window once. Beside it, ``corrected/<name>/version=<n>``
has windows as they are with all events of silver; of each window the highest version counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quakeframe.functions import times
from quakeframe.operators import statistics
from quakeframe.schema import QUAKES
from quakeframe.session import work_dir
from quakeframe.sources.tables import delete, exists
from quakeframe.streaming import live

SLACK = "interval 1 minute"  # files of one micro-batch are written within it
STATE = "name string, window timestamp, latest timestamp"
VERSIONS = "corrections"


def window_of(name: str, durations: str = "intended") -> tuple[int, int]:
    """Size and slide of a statistic's windows in seconds."""
    return statistics.WINDOWS[durations][live.WINDOW_OF[name]]


def windows_over(spans: DataFrame, name: str, durations: str) -> DataFrame:
    """``window``: the windows of a statistic that overlap ``[low, low + grain)``, given in seconds, for each row."""
    size, slide = window_of(name, durations)
    first = F.floor((F.col("low") - size) / slide) * slide + slide
    last = F.col("low") + F.col("grain") - 1
    return spans.select("bound", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"), F.lit(slide).cast("bigint"))).alias("w")).select(
        F.timestamp_seconds("w").alias("window"), F.timestamp_seconds(F.col("w") + size).alias("end"), "bound")


def recomputed(silver: DataFrame, windows: DataFrame, name: str, durations: str) -> DataFrame:
    """The given windows of a statistic from all events, shaped as they are stored; only days that they touch are read."""
    size, _ = window_of(name, durations)
    reach = F.col("window") + F.expr(f"interval {size - 1} seconds")
    days = windows.select(F.explode(F.sequence(F.to_date("window"), F.to_date(reach))).alias("date")).distinct()
    rows = silver.join(F.broadcast(days), "date", "left_semi")  # one row per day of the calendar
    return live.shaped(live.STATISTICS[name](rows, durations), name).join(windows, "window", "left_semi")


def read_statistic(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A live statistic with its corrections: of each window the rows of the highest version.

    Versions are whole windows, so that only the list of corrected windows, with their highest version, is
    joined to the table: nothing is grouped or sorted, and filters on ``date`` reach the folders.
    """
    base = live.read_table(spark, root, name)
    path = f"{root}/corrected/{name}"
    if not exists(spark, path):
        return base
    fixed = spark.read.schema(StructType([*base.schema, StructField("version", IntegerType())])).parquet(path)
    newest = fixed.groupBy("window").agg(F.max("version").alias("version"))
    kept = fixed.join(newest, ["window", "version"], "left_semi").drop("version")
    return base.join(newest, "window", "left_anti").unionByName(kept.select(*base.columns))


def _changed(fresh: DataFrame, current: DataFrame) -> DataFrame:
    """The windows whose rows differ: compared by number and sum of row hashes, one row per window on either side."""
    def mark(df: DataFrame) -> DataFrame:
        digest = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
        return df.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.sum(digest).alias("h"))

    a, b = mark(fresh).alias("a"), mark(current).alias("b")
    same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.h").eqNullSafe(F.col("b.h"))
    return a.join(b, F.col("a.window") == F.col("b.window"), "left").where(~same).select("a.window")


def _late_grains(batch: DataFrame, latest, delay: str, grain: int) -> DataFrame:
    """Spans of time that have new events, with the farthest event (``bound``) that any query may have seen before them.

    A query takes files in the order in which they were written. Its watermark at a file is at most the
    latest event of that file and of those before it, less the delay.
    """
    files = batch.groupBy("written").agg(F.max("event_time").alias("top"))
    second = F.unix_micros("written")
    upto = F.max("top").over(Window.orderBy(second).rangeBetween(Window.unboundedPreceding, 60_000_000))  # a row per file
    bounds = files.select("written", F.greatest(upto, F.lit(latest).cast("timestamp")).alias("bound"))
    grains = batch.groupBy("written", F.unix_seconds(times.floor_to(F.col("event_time"), grain)).alias("low")).agg(F.count(F.lit(1)).alias("n"))
    found = grains.join(bounds, "written").groupBy("low").agg((F.max("bound") - F.expr(f"interval {delay}")).alias("bound"))
    return found.select("low", F.lit(grain).alias("grain"), "bound")


def correct(
    spark: SparkSession, root: str, durations: str = "intended", delay: str = live.WATERMARK, checkpoints: str | None = None,
    names: Sequence[str] | None = None,
) -> None:
    """Computes anew the windows that late events have made wrong, under ``root``/corrected. To be run now and then beside the streams.

    A stream over silver, run to its end, brings what came since the last run: its checkpoint is the
    bookmark, so without new events nothing is read or written. Windows that a new event may have missed
    are looked at once they are closed, that is, when the statistic has written one that is not earlier;
    until then they are kept in a table of their own. A window whose rows differ from the stored ones is
    written with the number of the run as its version. A run that is repeated after a failure writes the
    same version again.
    """
    names = list(names or live.STATISTICS)
    grain = gcd(*(x for name in names for x in window_of(name, durations)))
    checkpoints = checkpoints or f"{root}/_checkpoints"

    def state(version: int) -> str:
        return f"{root}/{VERSIONS}/version={version}"

    def save(batch: DataFrame, number: int) -> None:
        version = number + 1
        session = batch.sparkSession
        silver = session.read.schema(QUAKES).parquet(f"{root}/silver")
        before = session.read.schema(STATE).parquet(state(number)) if number else session.createDataFrame([], STATE)
        latest = before.agg(F.max("latest").alias("t")).first()["t"]
        staged = work_dir(session, "late")
        _late_grains(batch, latest, delay, grain).write.parquet(staged)
        spans = session.read.parquet(staged)
        kept = [session.createDataFrame([], STATE)]
        for name in names:
            last = live.read_table(session, root, name).agg(F.max("window")).first()[0]  # one instant
            touched = windows_over(spans, name, durations).where("end <= bound").select("window")
            waiting = touched.unionByName(before.where(F.col("name") == name).select("window")).distinct()
            closed: Column = F.lit(False) if last is None else F.col("window") <= F.lit(last)
            ready = waiting.where(closed)
            kept.append(waiting.where(~closed).select(F.lit(name).alias("name"), "window", F.lit(None).cast("timestamp").alias("latest")))
            if ready.isEmpty():
                continue
            fresh = recomputed(silver, ready, name, durations)
            current = read_statistic(session, root, name).join(ready, "window", "left_semi")
            folder = f"{root}/corrected/{name}/version={version}"
            fresh.join(_changed(fresh, current), "window", "left_semi").write.mode("overwrite").parquet(folder)
        top = batch.agg(F.greatest(F.max("event_time"), F.lit(latest).cast("timestamp")).alias("latest"))
        kept.append(top.select(F.lit(None).cast("string").alias("name"), F.lit(None).cast("timestamp").alias("window"), "latest"))
        out = kept[0]
        for part in kept[1:]:
            out = out.unionByName(part)
        out.write.mode("overwrite").parquet(state(version))
        delete(session, staged)

    table = spark.readStream.schema(QUAKES).parquet(f"{root}/silver").select("event_time", F.col("_metadata.file_modification_time").alias("written"))
    query = table.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{checkpoints}/corrections").foreachBatch(save).start()
    query.awaitTermination()

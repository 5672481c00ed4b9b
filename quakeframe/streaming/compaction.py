"""Live tables by day: a log of micro-batches, compacted into one folder per day, read as one table.

A log has a folder for each micro-batch (``live.write_log``), with one for each day in it. Compaction copies
the days that have new batches into ``<log>/_days/version=<n>/date=<day>`` and then writes a manifest that
names the version in which each day lies and the last batch that is in them. A reader takes the newest
manifest that was written to its end: the days it names, and the batches behind its last one. It stays with
what it has listed, so it sees each row once, whatever is compacted meanwhile.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quakeframe.sources.tables import days_of, delete, names_in

MANIFEST = "date date, version int, last int"
DAYS, MANIFESTS = "_days", "_manifests"


def complete(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders ``<name>=<number>`` that were written to their end."""
    found = [int(m.group(1)) for m in (re.fullmatch(rf"{name}=(\d+)", x) for x in names_in(spark, path)) if m]
    return sorted(n for n in found if "_SUCCESS" in names_in(spark, f"{path}/{name}={n}"))


@dataclass(frozen=True)
class Snapshot:
    """What a reader is pinned to: a manifest (none before the first compaction), its days, and the batches behind it."""

    version: int | None
    days: tuple[tuple[str, int], ...]
    batches: tuple[int, ...]


def snapshot(spark: SparkSession, log: str, version: int | None = None) -> Snapshot:
    """The newest state of a log, or that of an earlier manifest. The manifest has a row for each day."""
    batches = complete(spark, log, "batch_id")
    versions = complete(spark, f"{log}/{MANIFESTS}", "version")
    if not versions:
        return Snapshot(None, (), tuple(batches))
    version = versions[-1] if version is None else version
    rows = spark.read.schema(MANIFEST).parquet(f"{log}/{MANIFESTS}/version={version}")
    entry = F.struct(F.col("date").cast("string").alias("date"), "version")
    days = F.collect_list(F.when(F.col("date").isNotNull(), entry))
    row = rows.agg(F.sort_array(days).alias("days"), F.max("last").alias("last")).first()
    return Snapshot(version, tuple((d["date"], d["version"]) for d in row["days"]), tuple(b for b in batches if b > row["last"]))


def read(spark: SparkSession, log: str, schema: StructType, at: Snapshot | None = None) -> DataFrame:
    """The rows of a log by day, with the columns of ``schema`` (``date`` among them).

    Only folders that the snapshot names are listed, and filters on ``date`` choose among them.
    """
    at = snapshot(spark, log) if at is None else at
    days = [f"{log}/{DAYS}/version={version}/date={date}" for date, version in at.days]
    batches = [f"{log}/batch_id={batch}" for batch in at.batches]
    out = spark.createDataFrame([], schema)
    names = schema.fieldNames()
    if days:
        kept = spark.read.schema(schema).option("basePath", f"{log}/{DAYS}").parquet(*days).select(*names)
        out = kept
    if batches:
        recent = spark.read.schema(schema).option("basePath", log).parquet(*batches).select(*names)
        out = out.unionByName(recent) if days else recent
    return out


def days_in(spark: SparkSession, log: str, at: Snapshot | None = None) -> list[str]:
    """The days of a log, newest first, from its manifest and the folders of the batches behind it."""
    at = snapshot(spark, log) if at is None else at
    found = {date for date, _ in at.days}
    return sorted(found.union(*(days_of(spark, f"{log}/batch_id={batch}") for batch in at.batches)), reverse=True)


def compact(spark: SparkSession, log: str, schema: StructType) -> int | None:
    """Gathers the batches since the last manifest into their days; returns the new version, if there is one.

    Only days that these batches have rows of are written, from their last version and the new rows; AQE
    splits a day that is too large for one file. Earlier versions are left to their readers (``expire``).
    """
    before = snapshot(spark, log)
    if not before.batches:
        return None
    version = 0 if before.version is None else before.version + 1
    names = schema.fieldNames()
    new = spark.read.schema(schema).option("basePath", log).parquet(*[f"{log}/batch_id={b}" for b in before.batches]).select(*names)
    touched = new.select("date").distinct()
    rows = new
    if before.days:
        old = read(spark, log, schema, Snapshot(before.version, before.days, ()))
        rows = new.unionByName(old.join(F.broadcast(touched), "date", "left_semi").select(*names))  # one row per day of the calendar
    folder = f"{log}/{DAYS}/version={version}"
    time = [c for c in ("date", "time") if c in names]
    rows.hint("rebalance", "date").sortWithinPartitions(*time).write.mode("overwrite").partitionBy("date").parquet(folder)
    entries = touched.where("date is not null").select("date", F.lit(version).alias("version"))
    if before.days:
        kept = spark.createDataFrame(list(before.days), "date string, version int").withColumn("date", F.to_date("date"))
        entries = entries.unionByName(kept.join(touched, "date", "left_anti"))
    # One row without a day: batches without rows have a last one too.
    entries = entries.unionByName(spark.createDataFrame([(None, None)], "date date, version int"))
    last = F.lit(before.batches[-1]).alias("last")
    entries.select("date", "version", last).coalesce(1).write.mode("overwrite").parquet(f"{log}/{MANIFESTS}/version={version}")
    return version


def expire(spark: SparkSession, log: str, keep: int = 2) -> None:
    """Removes what only manifests before the last ``keep`` name: their days, and the batches that are in days by all that stay."""
    versions = complete(spark, f"{log}/{MANIFESTS}", "version")
    stay = [snapshot(spark, log, v) for v in versions[-keep:]]
    if not stay:
        return
    used = {version for s in stay for _, version in s.days}
    for version in complete(spark, f"{log}/{DAYS}", "version"):
        if version not in used and version < versions[-1]:
            delete(spark, f"{log}/{DAYS}/version={version}")
    for batch in set(complete(spark, log, "batch_id")) - {b for s in stay for b in s.batches}:
        delete(spark, f"{log}/batch_id={batch}")
    for version in versions[:-keep]:
        delete(spark, f"{log}/{MANIFESTS}/version={version}")

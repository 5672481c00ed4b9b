"""The catalogue job: clean once into silver, then all statistics and points from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quakeframe.functions import bins, times
from quakeframe.operators import clean, points, statistics
from quakeframe.schema import KEPT_FIELDS, QUAKES
from quakeframe.session import work_dir
from quakeframe.sources import tables
from quakeframe.sources.catalogue import BLOCK, FILE, MIN_MAGNITUDE, RECORD, range_scan, read_records

SILVER = StructType([f for f in QUAKES if f.name != "date"] + [StructField("date", QUAKES["date"].dataType)])

STATISTICS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "monthly_region": statistics.monthly_region_stats,
    "weekly_region": statistics.weekly_region_stats,
    "daily_global": statistics.daily_global_stats,
    "monthly_magnitude": statistics.monthly_magnitude_stats,
    "monthly_depth": statistics.monthly_depth_stats,
}

POINTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "monthly_region": ("monthly_regional_stats", points.monthly_points),
    "weekly_region": ("weekly_regional_stats", points.weekly_points),
    "daily_global": ("daily_global_stats", points.daily_points),
    "monthly_magnitude": (
        "monthly_magnitude_stats", lambda df: points.monthly_points(df, "monthly_magnitude_stats")),
    "monthly_depth": ("monthly_depth_stats", lambda df: points.monthly_points(df, "monthly_depth_stats")),
}


def _existing(like: DataFrame, path: str) -> DataFrame | None:
    """A table with the schema of another, which an empty folder does not tell."""
    try:
        return like.sparkSession.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _days(df: DataFrame) -> DataFrame:
    return df.select("date").distinct()


def _time(df: DataFrame) -> str:
    return next(c for c in ("event_time", "time", "date") if c in df.columns)


def replace_days(rows: DataFrame, path: str, days: DataFrame) -> None:
    """Makes ``rows`` all that a table by day has on ``days``; the folder of a day without rows goes.

    ``rows`` must not be read from the table itself. ``days`` has one row per day of the calendar.
    """
    spark = rows.sparkSession
    tables.write_by_date(rows, path, _time(rows))
    gone = days.join(_days(rows), "date", "left_anti").agg(F.collect_list(F.col("date").cast("string")).alias("days"))
    for day in gone.first()["days"]:
        tables.delete(spark, f"{path}/date={day}")


def merge_silver(new: DataFrame, path: str, staged: str) -> DataFrame:
    """Adds events to a silver table by day; of several records of an event the last update stays.

    Returns the days that were rewritten: those of the new records, and those on which the table had
    a record of the same event, which a revision may have moved. They are merged under ``staged``
    first, as a table cannot safely be overwritten by what reads it.
    """
    spark = new.sparkSession
    tables.write_by_date(new, f"{staged}/new", "event_time")
    added, old = _existing(new, f"{staged}/new"), _existing(new, path)
    days = _days(added)
    if old is not None:
        days = days.unionByName(_days(old.join(added.select("id").distinct(), "id", "left_semi"))).distinct()
    days.write.parquet(f"{staged}/days")
    days = spark.read.schema("date date").parquet(f"{staged}/days")
    if old is None:
        tables.write_by_date(added, path, "event_time")
        return days
    # One row per day of the calendar is small whatever the number of events, and prunes the scan.
    touched = old.join(F.broadcast(days), "date", "left_semi").select(*added.columns)
    tables.write_by_date(clean.dedupe_latest(touched.unionByName(added)), f"{staged}/merged", "event_time")
    replace_days(_existing(new, f"{staged}/merged"), path, days)
    return days


def typed_range(raw: DataFrame, start=None, end=None, min_magnitude: float = MIN_MAGNITUDE) -> DataFrame:
    """Raw catalogue rows, of a time range or all, as silver rows."""
    typed = clean.type_catalogue(raw)
    wanted = (
        clean.quality_filter(typed, min_magnitude) if start is None
        else range_scan(typed, start, end, min_magnitude, ordered=False)
    )
    return clean.enrich(clean.dedupe_latest(wanted.drop("time")), "catalog")


def build_silver(
    raw: DataFrame, path: str, start=None, end=None, min_magnitude: float = MIN_MAGNITUDE,
) -> DataFrame:
    """Raw catalogue rows, of a time range or all, into the silver table, which is returned."""
    rows = typed_range(raw, start, end, min_magnitude)
    staged = work_dir(raw.sparkSession, "merge")
    merge_silver(rows, path, staged)
    tables.delete(raw.sparkSession, staged)
    return _existing(rows, path)


def unreadable(raw: DataFrame) -> DataFrame:
    """Catalogue rows, as they came, that cannot be used, with the reason: a record without the fields of the
    catalogue, or one whose id, time or magnitude is missing or cannot be read."""
    origin = [c for c in (RECORD, FILE, BLOCK) if c in raw.columns]
    reason = (
        F.when(F.coalesce(F.col("id"), F.lit("")) == "", "no id")
        .when(times.parse_catalogue_time(F.col("time")).isNull(), "no time")
        .when(bins.finite(F.col("mag")).isNull(), "no magnitude")
    )
    reason = F.when(F.col(RECORD).isNotNull(), "malformed").otherwise(reason) if RECORD in origin else reason
    return clean.dead_letters(raw.select(*KEPT_FIELDS, *origin), reason)


def well_formed(raw: DataFrame) -> DataFrame:
    """Records that have all fields, and an id: events without one would be taken for revisions of each other."""
    return raw.where(F.col(RECORD).isNull() & (F.col("id") != "")).drop(RECORD, FILE, BLOCK)


# The first day of the period of a statistic that a day belongs to. Published weeks join the calendar
# year with the ISO week, so their label is that of the pair.
_WEEK = lambda day: F.date_trunc("week", day).cast("date")
_MONTH = lambda day: F.trunc(day, "month")
PERIODS: dict[str, Callable[[Column], Column]] = {
    "monthly_region": _MONTH,
    "weekly_region": lambda day: times.iso_week_start(F.year(day), F.weekofyear(day)).cast("date"),
    "weekly_points": _WEEK,
    "daily_global": lambda day: day,
    "monthly_magnitude": _MONTH,
    "monthly_depth": _MONTH,
}


def periods(days: DataFrame, label: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """The periods (by first day) that some days belong to, and all days of these periods."""
    touched = days.select(label(F.col("date")).alias("period")).distinct()
    year = F.date_trunc("year", "date").cast("date")
    calendar = days.select(F.explode(F.sequence(F.date_sub(year, 7), F.date_add(year, 373))).alias("date")).distinct()
    every = calendar.withColumn("period", label(F.col("date"))).join(touched, "period", "left_semi").select("date")
    return touched.select(F.col("period").alias("date")), every


def run_batch(
    spark: SparkSession, csv_path: str, root: str, start=None, end=None,
    min_magnitude: float = MIN_MAGNITUDE, preview: int = 0,
) -> dict[str, DataFrame]:
    """Silver table, dead letters, raw points and statistics under ``root``.

    A run over a time range adds to the silver table. Each statistic is then computed anew for those
    of its periods that a rewritten day belongs to, from all days of these periods; so runs over
    ranges, in any order and overlapping, add up to one run over all. Statistics are tables by the
    first day of their periods; the CSV files are an export of the whole tables, and points are shaped
    from the tables, so no text passes through CSV on its way to a point.
    """
    raw, staged = read_records(spark, csv_path), work_dir(spark, "batch")
    unreadable(raw).write.mode("overwrite").parquet(f"{root}/unreadable")
    days = merge_silver(typed_range(well_formed(raw), start, end, min_magnitude), f"{root}/silver", staged)
    silver = spark.read.schema(SILVER).parquet(f"{root}/silver")
    touched = silver.join(F.broadcast(days), "date", "left_semi").select(*SILVER.names)

    def update(rows: DataFrame, name: str, replaced: DataFrame) -> DataFrame:
        tables.write_by_date(rows, f"{staged}/{name}", _time(rows))
        replace_days(_existing(rows, f"{staged}/{name}"), f"{root}/{name}", replaced)
        return _existing(rows, f"{root}/{name}")

    update(clean.dead_letters(touched, clean.point_reject_reason()), "dead_letters", days)
    update(_dated(points.event_points(touched)), "points/earthquake_events", days)
    out = {}
    for name, compute in STATISTICS.items():
        firsts, every = periods(days, PERIODS[name])
        of_periods = silver.join(F.broadcast(every), "date", "left_semi").select(*SILVER.names)
        stats = compute(of_periods)
        label = F.col("date") if name == "daily_global" else (
            times.iso_week_start(F.col("year"), F.col("week")) if name == "weekly_region"
            else times.month_start(F.col("year"), F.col("month")))
        table = update(stats.withColumn("date", label.cast("date")), f"stats/{name}", firsts)
        out[name] = table.select(*stats.columns)
        tables.write_csv(out[name], f"{root}/stats_{name}")
        measurement, shape = POINTS[name]
        if name == "weekly_region":  # points lie at ISO weeks, which the published statistic splits at New Year
            firsts, every = periods(days, PERIODS["weekly_points"])
            shaped = shape(statistics.weekly_region_stats(
                silver.join(F.broadcast(every), "date", "left_semi").select(*SILVER.names), by_iso_year=True))
        else:
            shaped = shape(table.join(F.broadcast(firsts), "date", "left_semi").select(*stats.columns))
        update(_dated(shaped), f"points/{measurement}", firsts)
    tables.delete(spark, staged)
    if preview:
        for stats in out.values():
            peek(stats, preview).show(truncate=False)
    return out


def _dated(shaped: DataFrame) -> DataFrame:
    return shaped.withColumn("date", F.to_date("time"))


def peek(df: DataFrame, n: int = 10, *columns: str) -> DataFrame:
    """The first rows; showing them runs the plan again."""
    return df.select(*[F.col(c) for c in columns] or ["*"]).limit(n)

"""Registered queries: one callable per operator and, where SQL can say it, the comparison SQL.

Every query reads the whole ``events`` table. Relative ranges end at the latest event.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.functions import bins, place, times
from quakeframe.operators import alerts, buckets, clean, metrics, panels, points, statistics
from quakeframe.plans import batch
from quakeframe.plans import oracle as o
from quakeframe.plans.events import catalogue, live, quakes
from quakeframe.schema import CATALOGUE_FIELDS, KEPT_FIELDS, MEASUREMENTS
from quakeframe.session import work_dir
from quakeframe.sources import catalogue as scans
from quakeframe.sources.tables import delete, range_filter, read_points, write_by_date, write_csv
from quakeframe.streaming import replay, rules
from quakeframe.streaming.live import event_or_arrival

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return keep


def over(table: Callable[[SparkSession, str], DataFrame], compute: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: compute(table(spark, sf))


# --- tables the queries start from ------------------------------------------------------------

def batch_points(spark, sf):
    return points.event_points(catalogue(spark, sf))


def stream_points(spark, sf):
    return points.event_points(live(spark, sf))


def all_points(spark, sf):
    return panels.union(batch_points(spark, sf), stream_points(spark, sf))


def weekly_points(spark, sf):
    return points.weekly_points(statistics.weekly_region_stats(catalogue(spark, sf), by_iso_year=True))


def rolling_points(spark, sf):
    return points.rolling_points(statistics.rolling_7day(live(spark, sf)), "7day")


def daily_points(spark, sf):
    return points.daily_points(statistics.daily_global_stats(catalogue(spark, sf)))


def hourly_points(spark, sf):
    return points.global_stream_points(statistics.hourly_global(live(spark, sf)))


def daily_stream_points(spark, sf):
    return points.global_stream_points(statistics.daily_global(live(spark, sf)), "daily_global_stats_stream")


def daily_both(spark, sf):
    """The daily statistics of both paths, which share a measurement."""
    return panels.union(daily_points(spark, sf), daily_stream_points(spark, sf))


def sequence_points(spark, sf):
    return points.sequence_points(statistics.sequences(live(spark, sf), size=86400))


WEEKLY_POINTS = f"""SELECT CAST(date_trunc('week', event_time) AS TIMESTAMP) AS time, region, year, week,
  {o.mags(3)} FROM catalogue GROUP BY ALL"""
ROLLING_POINTS = f"SELECT min_event_time AS time, region, eq_count, avg_mag, max_mag FROM ({o.ROLLING_7DAY})"
DAILY_POINTS = f"SELECT CAST(date AS TIMESTAMP) AS time, 'batch' AS source, eq_count, avg_mag, max_mag FROM ({o.DAILY})"
HOURLY_POINTS = f"""SELECT min_event_time AS time, 'global' AS region, 'stream' AS source,
  eq_count, avg_mag, max_mag FROM ({o.HOURLY})"""
DAILY_BOTH = f"""SELECT * FROM ({DAILY_POINTS}) UNION ALL
  SELECT min_event_time AS time, 'stream' AS source, eq_count, avg_mag, max_mag
  FROM ({o.tumbling('24 hours', '', o.mags(2))})"""
SEQUENCE_POINTS = f"SELECT min_event_time AS time, region, eq_count, avg_mag, max_mag FROM ({o.SEQUENCES})"

# --- scans ------------------------------------------------------------------------------------

_RANGE = "event_time >= TIMESTAMP '2024-01-08' AND event_time <= TIMESTAMP '2024-01-22'"
register("catalog_range_scan", o.sql(
    f"SELECT id, event_time, mag, place FROM quakes WHERE {_RANGE} AND mag >= 4.0"))(
    over(quakes, lambda df: scans.range_scan(df, "2024-01-08", "2024-01-22").select(
        "id", "event_time", "mag", "place")))

register("catalog_lookback_scan", o.sql(
    f"SELECT id, event_time, mag, place FROM {o.since('quakes', '3 days', 'event_time')} AND mag >= 4.0"))(
    over(quakes, lambda df: scans.lookback_scan(df, 3 * 86400).select("id", "event_time", "mag", "place")))

register("points_range_scan", o.sql(
    """SELECT event_id, time, region, magnitude FROM points
    WHERE time >= TIMESTAMP '2024-01-10' AND time < TIMESTAMP '2024-01-20'""", "points"))(
    over(batch_points, lambda df: range_filter(df, "2024-01-10", "2024-01-20").select(
        "event_id", "time", "region", "magnitude")))


# --- typing and parsing -----------------------------------------------------------------------

def _raw_text(df: DataFrame) -> DataFrame:
    """Events as catalogue text: every column a string, half of the times as epoch milliseconds."""
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    millis = F.unix_millis("event_time").cast("string")
    time = F.when(F.col("longitude") < 0, millis).otherwise(iso)
    numbers = {c: F.col(c).cast("string") for c in ("latitude", "longitude")}
    return df.withColumns({
        **numbers, "time": time,
        "depth": F.coalesce(F.col("depth").cast("string"), F.lit("n/a")),
        "mag": F.when(F.col("place").isNotNull(), F.col("mag").cast("string")).otherwise("bad"),
    }).drop("event_time", "updated")


_MILLIS = "date_trunc('milliseconds', event_time)"
register("catalog_typed", o.sql(
    f"""SELECT id, {_MILLIS} AS event_time, latitude, longitude, depth,
    CASE WHEN place IS NOT NULL THEN mag END AS mag, magType, place FROM quakes"""))(
    over(quakes, lambda df: clean.type_catalogue(_raw_text(df)).select(
        "id", "event_time", "latitude", "longitude", "depth", "mag", "magType", "place")))



def csv_round_trip(spark, sf):
    """The catalogue text written as CSV with a header and read back."""
    raw = _raw_text(quakes(spark, sf)).select(*KEPT_FIELDS)
    path = work_dir(spark, "csv")
    write_csv(raw, path)
    return clean.type_catalogue(scans.read_csv(spark, path, raw.schema)).drop("time", "updated")


register("csv_round_trip", ORACLES["catalog_typed"])(csv_round_trip)


def store_round_trip(spark, sf):
    """Points written by day and a range of them read back."""
    path = work_dir(spark, "points")
    write_by_date(batch_points(spark, sf), path)
    return read_points(spark, path, "2024-01-10", "2024-01-20").select("event_id", "time", "region", "magnitude")


register("points_store_round_trip", ORACLES["points_range_scan"])(store_round_trip)

# --- batch runs that follow one another ---------------------------------------------------------

def _spread(spark, sf) -> DataFrame:
    """Events over four months, a day later for every id, so that runs meet months and New Year."""
    return quakes(spark, sf).withColumn("event_time", times.shift_days(F.col("event_time"), F.col("id").cast("int") % 100 - 60))


_SPREAD = """SELECT * REPLACE (event_time + INTERVAL 1 DAY * CAST(event_id % 100 - 60 AS INTEGER) AS event_time)
  FROM quakes"""


def _as_csv(df: DataFrame, path: str) -> None:
    raw = df.withColumn("time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    table = raw.select(*[F.col(c).cast("string").alias(c) if c in raw.columns else F.lit("z").alias(c) for c in CATALOGUE_FIELDS if c != "updated"])
    write_csv(table.withColumn("updated", F.col("time")).select(*CATALOGUE_FIELDS), path)


def range_rerun(spark, sf):
    """The stored points after a run over all and a second one over two days at the edge of a month."""
    root = work_dir(spark, "range-rerun")
    _as_csv(_spread(spark, sf), f"{root}/in")
    batch.run_batch(spark, f"{root}/in", f"{root}/out")
    batch.run_batch(spark, f"{root}/in", f"{root}/out", "2023-12-31T06:00:00", "2024-01-01T18:00:00")
    tables = [
        spark.read.parquet(f"{root}/out/points/{name}").select(F.lit(name).alias("measurement"), "time", "region", "eq_count", "avg_mag", "max_mag")
        for name in ("monthly_regional_stats", "weekly_regional_stats")
    ]
    return tables[0].unionByName(tables[1])


register("batch_range_rerun", o.sql(
    f"""SELECT 'monthly_regional_stats' AS measurement, CAST(date_trunc('month', event_time) AS TIMESTAMP) AS time, region, {o.mags(3)}
    FROM late GROUP BY ALL UNION ALL
    SELECT 'weekly_regional_stats', CAST(date_trunc('week', event_time) AS TIMESTAMP), region, {o.mags(3)} FROM late GROUP BY ALL""",
    spread=_SPREAD, late=f"SELECT *, {o.REGION_CAT} AS region FROM spread WHERE mag >= 4.0"))(range_rerun)


def revision_over_midnight(spark, sf):
    """The silver table after every 20th event was moved to the next day by a revision."""
    path = f"{work_dir(spark, 'revision')}/silver"
    first = clean.enrich(clean.quality_filter(quakes(spark, sf)), "catalog")
    moved = quakes(spark, sf).where(F.col("id").cast("int") % 20 == 0).withColumns({
        "event_time": times.shift_days(F.col("event_time"), F.lit(1)), "updated": times.shift_days(F.col("updated"), F.lit(1))})
    for rows in (first, clean.enrich(clean.quality_filter(moved), "catalog")):
        staged = work_dir(spark, "merge")
        batch.merge_silver(rows, path, staged)
        delete(spark, staged)
    return spark.read.parquet(path).select("id", "event_time", "updated", "mag")


register("silver_revision_over_midnight", o.sql(
    """SELECT id, event_time + moved AS event_time, updated + moved AS updated, mag FROM (
      SELECT *, INTERVAL 1 DAY * CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END AS moved FROM quakes) WHERE mag >= 4.0"""))(
    revision_over_midnight)


def batch_dead_letters(spark, sf):
    """Catalogue rows without a readable time or magnitude: here every 7th and every 11th."""
    n = F.col("id").cast("int")
    raw = quakes(spark, sf).withColumns({
        "time": F.when(n % 7 == 0, "yesterday").otherwise(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        "mag": F.when(n % 11 == 0, "strong").otherwise(F.col("mag").cast("string")),
    })
    raw = raw.select(*[F.col(c).cast("string").alias(c) for c in KEPT_FIELDS])
    return batch.unreadable(raw).select("id", "reason")


register("batch_dead_letters", o.sql(
    """SELECT id, CASE WHEN event_id % 7 = 0 THEN 'no time' ELSE 'no magnitude' END AS reason
    FROM quakes WHERE event_id % 7 = 0 OR event_id % 11 = 0"""))(batch_dead_letters)

register("parse_time_catalog", o.sql(f"SELECT id, {_MILLIS} AS event_time FROM quakes"))(
    over(quakes, lambda df: _raw_text(df).select(
        "id", times.parse_catalogue_time(F.col("time")).alias("event_time"))))


def _live_text(time: str = "event_time"):
    """Six digits of a second, but none at all where the depth is missing."""
    full = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.col("depth").isNotNull(), full).otherwise(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


register("parse_time_live", o.sql(
    "SELECT id, CASE WHEN depth IS NOT NULL THEN event_time END AS event_time FROM quakes"))(
    over(quakes, lambda df: df.select(
        "id", times.parse_live_time(_live_text()).alias("event_time"))))


def messages(spark, sf):
    """Live messages made of the events.

    Without a latitude the message is cut off, without a place its magnitude is zero, and without
    a depth its time has no fraction.
    """
    df = quakes(spark, sf)
    text = F.to_json(F.struct(
        "id", _live_text().alias("time"), "latitude", "longitude", "depth",
        F.when(F.col("place").isNotNull(), F.col("mag")).otherwise(0.0).alias("mag"),
        "magType", "place", F.lit("earthquake").alias("type"),
    ))
    cut = F.when(F.col("latitude").isNull(), F.substring(text, 1, 20)).otherwise(text)
    return df.select(cut.alias("value"), F.col("event_time").alias("timestamp"))


_WHOLE = "latitude IS NOT NULL"
_CUT_MAG = "CASE WHEN place IS NULL THEN 0.0 ELSE mag END"
register("event_time_or_arrival", o.sql(
    f"SELECT id, event_time FROM quakes WHERE {_WHOLE}"))(
    over(messages, lambda df: event_or_arrival(clean.parse_live(df)).where("_corrupt is null").select("id", "event_time")))
register("parse_json_events", o.sql(
    f"""SELECT id, CASE WHEN depth IS NOT NULL THEN event_time END AS event_time, latitude, longitude, depth,
    CAST({_CUT_MAG} AS DOUBLE) AS mag, magType, place FROM quakes WHERE {_WHOLE}"""))(
    over(messages, lambda df: clean.parse_live(df).where(F.col("_corrupt").isNull()).select(
        "id", "event_time", "latitude", "longitude", "depth", "mag", "magType", "place")))

register("json_to_string_map", o.sql(
    f"SELECT id, magType AS mag_type, CAST(latitude AS VARCHAR) AS latitude, place FROM quakes WHERE {_WHOLE}"))(
    over(messages, lambda df: clean.message_map(df).where("entries['id'] IS NOT NULL AND entries['type'] IS NOT NULL").selectExpr(
        "entries['id'] AS id", "entries['magType'] AS mag_type", "entries['latitude'] AS latitude",
        "entries['place'] AS place")))


def _rejected(parsed: DataFrame) -> DataFrame:
    return clean.dead_letters(parsed, clean.live_reject_reason(parsed))


_LIVE_REASON = f"""CASE WHEN NOT ({_WHOLE}) THEN 'no id' WHEN {_CUT_MAG} = 0 THEN 'no magnitude'
  WHEN depth IS NULL THEN 'no time' END"""
register("dead_letter_rows", o.sql(
    f"SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT {_LIVE_REASON} AS reason FROM quakes) "
    "WHERE reason IS NOT NULL GROUP BY 1"))(
    over(messages, lambda df: _rejected(clean.parse_live(df)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))))

register("live_required_fields", o.sql(
    f"""SELECT id, event_time, mag FROM quakes
    WHERE {_WHOLE} AND place IS NOT NULL AND depth IS NOT NULL AND mag >= 4.0"""))(
    over(messages, lambda df: clean.live_required(clean.parse_live(df)).select("id", "event_time", "mag")))

register("quality_filter", o.sql("SELECT id, event_time, mag FROM quakes WHERE event_time IS NOT NULL AND mag >= 4.0"))(
    over(quakes, lambda df: clean.quality_filter(df).select("id", "event_time", "mag")))

# --- scalar columns ---------------------------------------------------------------------------


def dated(df: DataFrame) -> DataFrame:
    """Dates as text: drivers differ in how they hand out DATE values."""
    return df.withColumn("date", F.col("date").cast("string"))


def _dated(query: str) -> str:
    return f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM ({query})"


def scalar(name: str, column: Callable[[], Column], sql: str) -> None:
    register(name, o.sql(f"SELECT id, {sql} AS {name} FROM quakes"))(
        over(quakes, lambda df: df.select("id", column().alias(name))))


register("calendar_parts", o.sql(_dated(f"SELECT id, {o.CALENDAR} FROM quakes")))(
    over(quakes, lambda df: dated(df.select(
        "id", *[c.alias(n) for n, c in times.calendar_parts(F.col("event_time")).items()]))))
scalar("mag_bin_catalog", lambda: bins.catalogue_magnitude_bin(F.col("mag")), o.MAG_CAT)
# The shift by five makes some magnitudes negative.
scalar("mag_bin_live", lambda: bins.live_magnitude_bin(F.col("mag") - 5), o.MAG_LIVE.replace("mag", "(mag - 5)"))
scalar("depth_bin_catalog", lambda: bins.catalogue_depth_bin(F.col("depth")), o.DEPTH_CAT)
scalar("depth_bin_live", lambda: bins.live_depth_bin(F.col("depth")), o.DEPTH_LIVE)
scalar("region_catalog", lambda: place.catalogue_region(F.col("place")), o.REGION_CAT)
scalar("region_live", lambda: place.live_region(F.col("place")), o.REGION_LIVE)
register("geo_grid_cell", o.sql(
    f"""SELECT id, CAST({o.grid('latitude')} AS DOUBLE) AS lat_grid, CAST({o.grid('longitude')} AS DOUBLE) AS lon_grid
    FROM quakes"""))(
    over(quakes, lambda df: df.select(
        "id", bins.grid_cell(F.col("latitude")).cast("double").alias("lat_grid"),
        bins.grid_cell(F.col("longitude")).cast("double").alias("lon_grid"))))
scalar("alert_level", lambda: bins.alert_level(F.col("mag")),
       "CASE WHEN mag >= 7 THEN 'critical' WHEN mag >= 6.5 THEN 'high' ELSE 'moderate' END")
# Count and maximum of each group of one day and region.
register("sequence_class", o.sql(
    f"""SELECT CAST(date AS VARCHAR) AS date, region, {o.N}, {o.SEQUENCE_TYPE.format(n='count(*)', m='max(mag)')} AS sequence_class
    FROM catalogue GROUP BY 1, 2""", "catalogue"))(
    over(catalogue, lambda df: dated(df).groupBy("date", "region").agg(
        F.count(F.lit(1)).alias("eq_count"), F.max("mag").alias("m")).select(
        "date", "region", "eq_count", bins.sequence_type(F.col("eq_count"), F.col("m")).alias("sequence_class"))))
register("period_start", o.sql(
    """SELECT id, CAST(date_trunc('month', event_time) AS TIMESTAMP) AS month_start,
    CAST(date_trunc('week', event_time) AS TIMESTAMP) AS week_start, CAST(CAST(event_time AS DATE) AS VARCHAR) AS date
    FROM quakes"""))(
    over(quakes, lambda df: dated(df.select(
        "id", times.month_start(F.year("event_time"), F.month("event_time")).alias("month_start"),
        times.iso_week_start(times.iso_year(F.col("event_time")), F.weekofyear("event_time")).alias("week_start"),
        F.to_date("event_time").alias("date")))))


def _bands(x: str, steps) -> str:
    arms = " ".join(f"WHEN {x} >= {b} THEN '{c}'" for b, c in reversed(steps[1:]))
    return f"CASE WHEN {x} IS NULL THEN NULL {arms} ELSE '{steps[0][1]}' END"


register("threshold_bands", o.sql(
    f"""SELECT id, {_bands('mag', bins.EVENT_BANDS)} AS event_band, {_bands('mag', bins.MAP_BANDS)} AS map_band,
    {_bands('mag', bins.MAX_MAGNITUDE_BANDS)} AS max_band, {_bands('depth', bins.DAILY_COUNT_BANDS)} AS count_band
    FROM quakes"""))(
    over(quakes, lambda df: df.select(
        "id", bins.band(F.col("mag"), bins.EVENT_BANDS).alias("event_band"),
        bins.band(F.col("mag"), bins.MAP_BANDS).alias("map_band"),
        bins.band(F.col("mag"), bins.MAX_MAGNITUDE_BANDS).alias("max_band"),
        bins.band(F.col("depth"), bins.DAILY_COUNT_BANDS).alias("count_band"))))

register("significant_events", o.sql("SELECT id, event_time, mag, region FROM catalogue WHERE mag >= 6", "catalogue"))(
    over(catalogue, lambda df: statistics.significant(df).select("id", "event_time", "mag", "region")))

# --- deduplication ----------------------------------------------------------------------------


def duplicated(spark, sf):
    return quakes(spark, sf, duplicates=True)


_DEDUPED = """SELECT id, event_time, updated, mag, depth, place FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS rn FROM duplicated) WHERE rn = 1"""
_DEDUPE_COLUMNS = ["id", "event_time", "updated", "mag", "depth", "place"]
register("dedupe_latest", o.sql(_DEDUPED.format(order="updated DESC, event_time"), "duplicated"))(
    over(duplicated, lambda df: clean.dedupe_latest(df).select(*_DEDUPE_COLUMNS)))
register("dedupe_first", o.sql(_DEDUPED.format(order="event_time"), "duplicated"))(
    over(duplicated, lambda df: clean.dedupe_first(df).select(*_DEDUPE_COLUMNS)))


def catalogue_job(spark: SparkSession, sf: str) -> DataFrame:
    """Filter, deduplicate, enrich and aggregate: the batch job from raw rows to one statistic."""
    unique = clean.dedupe_latest(clean.quality_filter(duplicated(spark, sf)))
    return statistics.monthly_region_stats(clean.enrich(unique, "catalog"))


register("catalog_job_monthly", o.sql(
    f"SELECT year, month, region, {o.mags(3)} FROM kept GROUP BY ALL", "duplicated",
    kept=f"""SELECT *, {o.CALENDAR}, {o.REGION_CAT} AS region FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated DESC, event_time) AS rn
      FROM duplicated WHERE mag >= 4.0) WHERE rn = 1"""))(catalogue_job)

# --- batch statistics -------------------------------------------------------------------------

register("monthly_region_stats", o.sql(
    f"SELECT year, month, region, {o.mags(3)} FROM catalogue GROUP BY ALL", "catalogue"))(
    over(catalogue, statistics.monthly_region_stats))
register("weekly_region_stats", o.sql(o.WEEKLY, "catalogue"))(over(catalogue, statistics.weekly_region_stats))
register("daily_global_stats", o.sql(_dated(o.DAILY), "catalogue"))(
    over(catalogue, lambda df: dated(statistics.daily_global_stats(df))))
register("monthly_magnitude_stats", o.sql(o.MONTHLY_MAGNITUDE, "catalogue"))(
    over(catalogue, statistics.monthly_magnitude_stats))
register("monthly_depth_stats", o.sql(o.MONTHLY_DEPTH, "catalogue"))(over(catalogue, statistics.monthly_depth_stats))

# --- windowed statistics ----------------------------------------------------------------------

register("hourly_global_stats", o.sql(o.HOURLY, "live"))(over(live, statistics.hourly_global))
register("daily_global_windowed", o.sql(o.tumbling("24 hours", "", o.mags(2)), "live"))(
    over(live, statistics.daily_global))
register("rolling_24h_region", o.sql(o.ROLLING_24H, "live"))(over(live, statistics.rolling_24h))
register("rolling_24h_region_direct", o.sql(o.ROLLING_24H, "live"))(
    over(live, lambda df: statistics.rolling_24h(df, panes=False)))
_PANES = f", CAST(count(DISTINCT {o.bucket('1 hour')}) AS BIGINT) AS n_panes"
register("rolling_24h_region_panes", o.sql(o.sliding("24 hours", "1 hour", 24, _PANES), "live"))(
    over(live, lambda df: statistics.rolling_24h(df, count_panes=True)))
register("rolling_7d_region", o.sql(o.ROLLING_7DAY, "live"))(over(live, statistics.rolling_7day))
register("significant_event_alerts", o.sql(
    f"""SELECT *, CASE WHEN max_mag >= 7 THEN 'critical' WHEN max_mag >= 6.5 THEN 'high' ELSE 'moderate' END
    AS alert_level FROM ({o.tumbling('5 minutes', 'region', o.mags(2), where='mag >= 6')})""", "live"))(
    over(live, statistics.significant_alerts))
register("realtime_magnitude_distribution", o.sql(o.LIVE_MAGNITUDE, "live"))(
    over(live, statistics.magnitude_distribution))
register("depth_pattern_analysis", o.sql(o.LIVE_DEPTH, "live"))(over(live, statistics.depth_patterns))
# Events of the fixture are too sparse for half an hour, so the window is a day.
register("rapid_sequence_detection", o.sql(o.SEQUENCES, "live"))(
    over(live, lambda df: statistics.sequences(df, size=86400)))
register("global_count_range", o.sql(f"SELECT {o.N}, {o.SPAN}, 'global' AS region FROM live", "live"))(
    over(live, statistics.global_count_range))

# --- points -----------------------------------------------------------------------------------

_EVENT_FIELDS = ["magnitude", "latitude", "longitude", "depth"]
_SERIES = """'depth_bin=' || depth_bin || ',mag_bin=' || mag_bin || ',mag_type=' || mag_type
  || ',region=' || region || ',source=' || source"""
_LONG = " UNION ALL ".join(
    [f"SELECT 'earthquake_events' AS measurement, {_SERIES} AS series, '{f}' AS field, {f} AS value_num, "
     f"CAST(NULL AS VARCHAR) AS value_str, time FROM points WHERE {f} IS NOT NULL" for f in _EVENT_FIELDS]
    + [f"SELECT 'earthquake_events', {_SERIES}, '{f}', CAST(NULL AS DOUBLE), {f}, time FROM points "
       f"WHERE {f} IS NOT NULL" for f in ("event_id", "place")])
_LONG_COLUMNS = ["measurement", "series", "field", "value_num", "value_str", "time"]


def long_events(spark, sf):
    return points.to_long(batch_points(spark, sf), "earthquake_events")


register("points_long_events", o.sql(_LONG, "points"))(over(long_events, lambda df: df.select(*_LONG_COLUMNS)))
register("points_long_daily", o.sql(
    " UNION ALL ".join(
        f"SELECT 'daily_global_stats' AS measurement, 'source=batch' AS series, '{f}' AS field, "
        f"CAST({f} AS DOUBLE) AS value_num, CAST(NULL AS VARCHAR) AS value_str, time FROM daily"
        for f in ("eq_count", "avg_mag", "max_mag")), "catalogue", daily=DAILY_POINTS))(
    over(daily_points, lambda df: points.to_long(df, "daily_global_stats").select(*_LONG_COLUMNS)))
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"
register("points_long_stream", o.sql(
    " UNION ALL ".join([
        f"SELECT 'hourly_global_stats' AS measurement, 'region=global,source=stream' AS series, '{f}' AS field, {value}, min_event_time AS time FROM hours"
        for f, value in [
            *[(f, f"CAST({f} AS DOUBLE) AS value_num, CAST(NULL AS VARCHAR) AS value_str") for f in ("eq_count", "avg_mag", "max_mag")],
            *[(f, f"CAST(NULL AS DOUBLE) AS value_num, {_ISO.format(f)} AS value_str") for f in ("min_event_time", "max_event_time")],
        ]]), "live", hours=o.HOURLY))(
    over(hourly_points, lambda df: points.to_long(df, "hourly_global_stats").select(*_LONG_COLUMNS)))
register("points_pivot_by_time", o.sql(
    f"""SELECT {_SERIES} AS series, time, max(magnitude) AS magnitude, max(latitude) AS latitude,
    max(longitude) AS longitude, max(place) AS place FROM points GROUP BY 1, 2""", "points"))(
    over(long_events, lambda df: points.pivot_fields(
        df, ["series", "time"], ["magnitude", "latitude", "longitude"], ["place"])))


def _pivot_by_region(spark, sf):
    long = points.to_long(weekly_points(spark, sf), "weekly_regional_stats")
    return points.pivot_fields(
        long.withColumn("region", F.col("tags")["region"]), ["region"], ["eq_count", "max_mag"], aggregate=F.sum
    ).select("region", "eq_count", F.round("max_mag", 3).alias("max_mag"))


register("points_pivot_by_region", o.sql(
    f"""SELECT region, CAST(sum(eq_count) AS DOUBLE) AS eq_count, {o.rounded('sum(max_mag)', 3)} AS max_mag
    FROM weekly GROUP BY 1""", "catalogue", weekly=WEEKLY_POINTS))(_pivot_by_region)


def _writes(spark, sf):
    """Each event as it was first written and, where there is one, its later revision without a depth."""
    df = clean.enrich(clean.quality_filter(duplicated(spark, sf)), "catalog")
    kept_depth = F.when(F.col("revision") == 0, F.col("depth"))
    return points.event_points(df.withColumn("depth", kept_depth)).withColumn("ingest_ts", F.col("time"))


_UPSERTED = ["time", "magnitude", "latitude", "longitude", "depth", "place"]
register("points_upsert", o.sql(
    """SELECT event_id AS event_id, source, max(time) AS time, any_value(magnitude) AS magnitude,
      any_value(latitude) AS latitude, any_value(longitude) AS longitude, any_value(depth) AS depth,
      any_value(place) AS place, max(time) AS ingest_ts
    FROM (SELECT time, source, event_id, magnitude, latitude, longitude, depth, place FROM points
      UNION ALL
      SELECT time + INTERVAL 10 SECOND, source, event_id, magnitude, latitude, longitude, NULL, place
      FROM points WHERE CAST(event_id AS BIGINT) % 20 = 0) GROUP BY 1, 2""", "points"))(
    over(_writes, lambda df: points.upsert(df, ["event_id", "source"], _UPSERTED)))

# --- panels -----------------------------------------------------------------------------------

register("live_feed_top50", o.sql(
    "SELECT time, place, magnitude FROM stream_points WHERE place IS NOT NULL ORDER BY time DESC LIMIT 50",
    "stream_points"))(over(stream_points, panels.live_feed))


def _map(table: str, where: str, n: int) -> str:
    return f"""SELECT time, event_id, magnitude, latitude, longitude, place, {_bands('magnitude', bins.MAP_BANDS)} AS band
    FROM (SELECT * FROM {table} WHERE {where} ORDER BY time DESC, event_id LIMIT {n})"""


register("map_top1000", o.sql(_map("points", "true", 1000), "points"))(over(batch_points, panels.event_map))
register("region_focus_map", o.sql(_map("points", "regexp_matches(region, '^pur')", 200), "points"))(
    over(batch_points, lambda df: panels.event_map(df, 200, region="^pur")))
register("recent_alerts", o.sql(
    """SELECT time, region, magnitude AS max_magnitude, CASE WHEN magnitude >= 7 THEN 'CRITICAL'
      WHEN magnitude >= 6 THEN 'HIGH' ELSE 'MEDIUM' END AS alert_level
    FROM stream_points WHERE magnitude >= 6 ORDER BY time DESC LIMIT 20""", "stream_points"))(
    over(stream_points, panels.recent_alerts))
register("latest_events_5min", o.sql(
    f"SELECT time, magnitude, region, depth_bin, latitude, longitude FROM {o.since('stream_points', '5 minutes')}",
    "stream_points"))(over(stream_points, panels.latest_events))


def _sum_by(key: str, *tables: str) -> str:
    rows = " UNION ALL ".join(f"SELECT {key}, eq_count FROM ({t})" for t in tables)
    return f"SELECT {key}, CAST(sum(eq_count) AS BIGINT) AS eq_count FROM ({rows}) GROUP BY 1"


def monthly_magnitude(spark, sf):
    return statistics.monthly_magnitude_stats(catalogue(spark, sf))


def live_magnitude(spark, sf):
    return statistics.magnitude_distribution(live(spark, sf))


register("magnitude_distribution_all", o.sql(
    _sum_by("mag_bin", o.MONTHLY_MAGNITUDE, o.LIVE_MAGNITUDE), "catalogue", "live"))(
    lambda spark, sf: panels.count_totals(["mag_bin"], monthly_magnitude(spark, sf), live_magnitude(spark, sf)))
register("magnitude_distribution_batch", o.sql(_sum_by("mag_bin", o.MONTHLY_MAGNITUDE), "catalogue"))(
    over(monthly_magnitude, lambda df: panels.count_totals(["mag_bin"], df)))
register("magnitude_distribution_live", o.sql(_sum_by("mag_bin", o.LIVE_MAGNITUDE), "live"))(
    over(live_magnitude, lambda df: panels.count_totals(["mag_bin"], df)))
register("depth_distribution_labelled", o.sql(
    f"""SELECT CASE depth_bin WHEN 'shallow' THEN 'Shallow' WHEN 'intermediate' THEN 'Intermediate'
      WHEN 'deep' THEN 'Deep' ELSE depth_bin END AS label, eq_count
    FROM ({_sum_by('depth_bin', o.MONTHLY_DEPTH, o.LIVE_DEPTH)})""", "catalogue", "live"))(
    lambda spark, sf: panels.depth_totals(
        statistics.monthly_depth_stats(catalogue(spark, sf)), statistics.depth_patterns(live(spark, sf))))
register("significant_max_by_region", o.sql(
    """SELECT region, magnitude, time, event_id FROM (SELECT *, row_number() OVER (PARTITION BY region
      ORDER BY magnitude DESC, time, event_id) AS rn FROM points WHERE magnitude >= 6) WHERE rn = 1""", "points"))(
    over(batch_points, panels.significant_max))

_BOTH = {"weekly": WEEKLY_POINTS, "rolling": ROLLING_POINTS}
_BOTH_ROWS = """(SELECT time, region, eq_count, avg_mag, max_mag FROM weekly UNION ALL
  SELECT time, region, eq_count, avg_mag, max_mag FROM rolling)"""


def both(compute):
    return lambda spark, sf: compute(weekly_points(spark, sf), rolling_points(spark, sf))


register("regional_activity_table", o.sql(
    f"""SELECT region, CAST(sum(eq_count) AS BIGINT) AS eq_count,
      CAST(sum(CAST(round(avg_mag * 1000) AS BIGINT)) AS DOUBLE) / 1000 AS sum_avg_mag,
      CAST(sum(CAST(round(max_mag * 1000) AS BIGINT)) AS DOUBLE) / 1000 AS sum_max_mag,
      CAST(sum(CAST(round(avg_mag * 1000) AS BIGINT) * eq_count) AS DOUBLE) / CAST(sum(eq_count) * 1000 AS DOUBLE)
        AS weighted_avg_mag, max(max_mag) AS max_mag
    FROM {_BOTH_ROWS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", "catalogue", "live", **_BOTH))(
    both(panels.regional_activity))
register("most_active_regions", o.sql(
    f"""SELECT region, CAST(sum(eq_count) AS BIGINT) AS eq_count FROM {_BOTH_ROWS}
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""", "catalogue", "live", **_BOTH))(both(panels.most_active))
register("regional_activity_trends", o.sql(
    f"""SELECT {o.bucket('1 day', 'time')} + INTERVAL '1 day' AS time, region,
      CAST(sum(eq_count) AS DOUBLE) / count(*) AS value FROM {_BOTH_ROWS} GROUP BY ALL""",
    "catalogue", "live", **_BOTH))(both(panels.activity_trends))
register("union_weekly_rolling", o.sql(
    """SELECT 'weekly_regional_stats' AS measurement, time, region, CAST(NULL AS VARCHAR) AS window_type,
      CAST(year AS VARCHAR) AS year, CAST(week AS VARCHAR) AS week, eq_count, avg_mag, max_mag FROM weekly UNION ALL
    SELECT 'rolling_regional_stats', time, region, '7day', NULL, NULL, eq_count, avg_mag, max_mag FROM rolling""",
    "catalogue", "live", **_BOTH))(
    both(lambda weekly, rolling: panels.union(
        weekly.withColumn("measurement", F.lit("weekly_regional_stats")),
        rolling.withColumn("measurement", F.lit("rolling_regional_stats")),
    ).select("measurement", "time", "region", "window_type", "year", "week", "eq_count", "avg_mag", "max_mag")))

for _field, _name in (("eq_count", "last_daily_count"), ("max_mag", "last_daily_max")):
    register(_name, o.sql(
        f"""SELECT source, time, {_field} FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY time DESC) AS rn
        FROM {o.since('daily', '7 days')}) WHERE rn = 1""", "catalogue", "live", daily=DAILY_BOTH))(
        over(daily_both, lambda df, f=_field: panels.last_value(df, f)))

# Each measurement with its table in Spark and the SQL of its rows.
_STORED = {
    "earthquake_events": (all_points, "SELECT * FROM all_points"),
    "daily_global_stats": (daily_both, DAILY_BOTH),
    "hourly_global_stats": (hourly_points, HOURLY_POINTS),
    "weekly_regional_stats": (weekly_points, WEEKLY_POINTS),
    "monthly_regional_stats": (
        over(catalogue, lambda df: points.monthly_points(statistics.monthly_region_stats(df))),
        f"SELECT year, month, region, {o.N} FROM catalogue GROUP BY ALL"),
    "monthly_magnitude_stats": (
        over(monthly_magnitude, lambda df: points.monthly_points(df, "monthly_magnitude_stats")), o.MONTHLY_MAGNITUDE),
    "monthly_depth_stats": (
        over(catalogue, lambda df: points.monthly_points(statistics.monthly_depth_stats(df), "monthly_depth_stats")),
        o.MONTHLY_DEPTH),
    "rolling_regional_stats": (
        lambda spark, sf: panels.union(
            rolling_points(spark, sf), points.rolling_points(statistics.rolling_24h(live(spark, sf)), "24h")),
        f"SELECT region FROM ({o.ROLLING_7DAY}) UNION ALL SELECT region FROM ({o.ROLLING_24H})"),
    "significant_event_alerts": (
        over(live, lambda df: points.alert_points(statistics.significant_alerts(df))),
        o.tumbling("5 minutes", "region", o.N, where="mag >= 6")),
    "realtime_magnitude_distribution": (
        over(live_magnitude, lambda df: points.stream_points(df, "realtime_magnitude_distribution")), o.LIVE_MAGNITUDE),
    "depth_pattern_analysis": (
        over(live, lambda df: points.stream_points(statistics.depth_patterns(df), "depth_pattern_analysis")), o.LIVE_DEPTH),
    "sequence_detection": (sequence_points, SEQUENCE_POINTS),
}
register("storage_statistics", o.sql(
    " UNION ALL ".join(
        f"SELECT '{m}' AS measurement, CAST(count(*) AS BIGINT) AS total_records FROM ({q})" for m, (_, q) in _STORED.items()),
    "all_points"))(
    lambda spark, sf: panels.storage_statistics(**{m: table(spark, sf) for m, (table, _) in _STORED.items()}))


def _mean(table: str, every: str) -> str:
    return f"""SELECT {o.bucket(every, 'time')} + INTERVAL '{every}' AS time, source,
      CAST(sum(eq_count) AS DOUBLE) / count(*) AS value FROM {table} GROUP BY ALL"""


register("batch_daily_trend", o.sql(_mean("daily", "1 day"), "catalogue", daily=DAILY_POINTS))(
    over(daily_points, lambda df: panels.count_trend(df, "1 day")))
register("bucket_mean_magnitude", o.sql(
    f"""SELECT {o.bucket('1 hour', 'time')} + INTERVAL '1 hour' AS time, region,
      {o.rounded(o.mean("magnitude"), 6)} AS value FROM points GROUP BY ALL""",
    "points"))(over(batch_points, lambda df: buckets.bucket_mean(df, ["region"], "magnitude", "1 hour").withColumn(
        "value", F.round("value", 6))))
register("live_minute_trend", o.sql(_mean("hourly", "1 minute"), "live", hourly=HOURLY_POINTS))(
    over(hourly_points, lambda df: panels.count_trend(df, "1 minute")))
register("batch_vs_stream", o.sql(
    _mean("daily", "1 day") + " UNION ALL " + _mean("hourly", "1 minute"), "catalogue", "live",
    daily=DAILY_POINTS, hourly=HOURLY_POINTS))(
    lambda spark, sf: panels.batch_vs_stream(daily_points(spark, sf), hourly_points(spark, sf)))
register("ingestion_rate", o.sql(
    f"""SELECT {o.bucket('1 minute', 'time')} + INTERVAL '1 minute' AS time, source, count(*) / 60.0::DOUBLE AS rate
    FROM {o.since('all_points', '1 hour')} GROUP BY ALL""", "all_points"))(over(all_points, panels.ingestion_rate))

_GAP_SPINE = """SELECT s.region, s.bucket, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT region, unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 DAY)) AS bucket
      FROM counts GROUP BY region) s
LEFT JOIN counts c ON c.region = s.region AND c.bucket = s.bucket"""
register("gap_filled_daily_counts", o.sql(
    _GAP_SPINE, "points",
    counts="""SELECT region, CAST(date_trunc('day', time) AS TIMESTAMP) AS bucket, count(*) AS n
    FROM points GROUP BY 1, 2"""))(
    over(batch_points, lambda df: buckets.calendar_count(df, ["region"])))


def _liveness_sql(panel: str, table: str, where: str, unit: str, back: str, now: str = o.as_of("all_points")) -> str:
    off, on = bins.FLAG_TEXTS[panel]
    step = {"day": "1 DAY", "year": "1 YEAR"}[unit]
    return f"""SELECT '{panel}' AS panel, bucket, CAST(n > 0 AS INTEGER) AS flag,
      CASE WHEN n > 0 THEN '{on}' ELSE '{off}' END AS status
    FROM (SELECT bucket, (SELECT count(*) FROM {table} WHERE {where} AND time >= {now} - INTERVAL '{back}' AND time <= {now}
        AND CAST(date_trunc('{unit}', time) AS TIMESTAMP) = bucket) AS n
      FROM (SELECT unnest(generate_series(CAST(date_trunc('{unit}', {now} - INTERVAL '{back}') AS TIMESTAMP),
        CAST(date_trunc('{unit}', {now}) AS TIMESTAMP), INTERVAL {step})) AS bucket))"""


def _all_liveness(*now: str) -> str:
    return o.sql(" UNION ALL ".join([
        _liveness_sql("streaming", "all_points", "source = 'stream'", "day", "1 day", *now),
        _liveness_sql("batch", "all_points", "source = 'batch'", "year", "12 months", *now),
        _liveness_sql("producer", "all_points", "true", "day", "1 day", *now),
        _liveness_sql("store", "all_points", "true", "day", "1 day", *now),
    ]), "all_points")


register("source_liveness", _all_liveness())(
    over(all_points, lambda df: panels.source_liveness(df, scans.as_of_column(df, "time"))))
# Kept by a stream, with zeros from timers, as of its watermark.
register("stream_replay_liveness", _all_liveness("(SELECT date_trunc('milliseconds', max(time)) - INTERVAL 30 SECOND FROM all_points)"))(
    lambda spark, sf: replay.status(spark, all_points(spark, sf)))

# --- metrics ----------------------------------------------------------------------------------

_STRONGEST = "row_number() OVER (PARTITION BY region ORDER BY magnitude DESC, time DESC, event_id DESC) AS rn"
register("metric_count_5min", o.sql(
    f"SELECT region, {o.N} FROM {o.since('stream_points', '5 minutes')} GROUP BY 1", "stream_points"))(
    over(stream_points, metrics.recent_count))
register("metric_magnitude_5min", o.sql(
    f"""SELECT region, depth_bin, magnitude FROM (SELECT *, {_STRONGEST}
    FROM {o.since('stream_points', '5 minutes')}) WHERE rn = 1""", "stream_points"))(
    over(stream_points, metrics.recent_strongest))
# A day instead of minutes: enough regions to compare the choice of the strongest event.
register("metric_magnitude_24h", o.sql(
    f"""SELECT region, depth_bin, magnitude FROM (SELECT *, {_STRONGEST}
    FROM {o.since('stream_points', '1 day')}) WHERE rn = 1""", "stream_points"))(
    over(stream_points, lambda df: metrics.recent_strongest(df, minutes=1440)))
register("metric_hourly_count", o.sql(
    """SELECT region, time, eq_count, avg_mag, max_mag FROM hourly
    WHERE time = (SELECT max(time) FROM hourly)""", "live", hourly=HOURLY_POINTS))(
    over(hourly_points, metrics.latest_hourly))
register("active_sequences", o.sql(
    f"SELECT time, region, eq_count, max_mag, avg_mag FROM {o.since('sequence', '2 days')} AND eq_count >= 3",
    "live", sequence=SEQUENCE_POINTS))(
    over(sequence_points, lambda df: metrics.active_sequences(df, hours=48)))
register("metric_swarm_flag", o.sql(
    f"""SELECT region, CAST(1 AS INTEGER) AS swarm_detected, eq_count AS sequence_count FROM (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY time DESC, eq_count DESC) AS rn
      FROM {o.since('sequence', '2 days')} AND eq_count >= 3) WHERE rn = 1""", "live", sequence=SEQUENCE_POINTS))(
    over(sequence_points, lambda df: metrics.swarm_flag(df, hours=48)))
register("metric_max_24h", o.sql(
    f"SELECT region, max(magnitude) AS max_magnitude FROM {o.since('stream_points', '24 hours')} GROUP BY 1",
    "stream_points"))(over(stream_points, metrics.max_magnitude))
register("points_processed", o.sql(
    f"""SELECT time, source, n, CAST(sum(n) OVER (PARTITION BY source ORDER BY time) AS BIGINT) AS total FROM (
      SELECT {o.bucket('1 day', 'time')} + INTERVAL '1 day' AS time, source, CAST(count(*) AS BIGINT) AS n
      FROM all_points GROUP BY 1, 2)""", "all_points"))(over(all_points, metrics.points_processed))
register("significant_events_total", o.sql(
    """SELECT region, mag_bin, CAST(count(*) AS BIGINT) AS total FROM stream_points
    WHERE magnitude >= 6 GROUP BY 1, 2""", "stream_points"))(over(stream_points, metrics.significant_totals))
register("regional_activity_level", o.sql(
    f"SELECT region, CAST(count(*) AS BIGINT) AS level FROM {o.since('stream_points', '1 hour')} GROUP BY 1",
    "stream_points"))(over(stream_points, metrics.activity_level))
register("source_freshness", o.sql(
    f"""SELECT source, max(time) AS last_update,
      (epoch_us({o.as_of('quakes', 'event_time')}) - epoch_us(max(time))) / 1e6 AS age_seconds
    FROM all_points GROUP BY 1""", "all_points"))(
    lambda spark, sf: metrics.freshness(all_points(spark, sf), scans.as_of_column(quakes(spark, sf))))


def _snapshot(spark, sf):
    return metrics.snapshot(
        stream_points(spark, sf), hourly_points(spark, sf), sequence_points(spark, sf),
        scans.as_of_column(live(spark, sf)),
    )


def _gauge(metric: str, value: str, table: str, label: str = "CAST(NULL AS VARCHAR)", tail: str = "") -> str:
    return (f"SELECT '{metric}' AS metric, region, {label} AS depth_bin, CAST({value} AS DOUBLE) AS value "
            f"FROM {table} {tail}")


_EVENT_GAUGES = [
    _gauge("earthquake_magnitude", "magnitude",
           f"(SELECT *, {_STRONGEST} FROM {o.since('stream_points', '5 minutes', of='live_times')})",
           "depth_bin", "WHERE rn = 1"),
    _gauge("earthquake_count_5min", "count(*)", o.since("stream_points", "5 minutes", of="live_times"), tail="GROUP BY region"),
    _gauge("max_earthquake_magnitude_24h", "max(magnitude)",
           o.since("stream_points", "24 hours", of="live_times"), tail="GROUP BY region"),
]
register("metrics_snapshot", o.sql(" UNION ALL ".join([
    *_EVENT_GAUGES,
    _gauge("earthquake_count_hourly", "eq_count",
           f"(SELECT *, row_number() OVER (ORDER BY time DESC) AS rn FROM {o.since('hourly', '1 hour', of='live_times')})",
           tail="WHERE rn = 1"),
    _gauge("earthquake_swarm_detected", "1", o.since("sequence", "1 hour", of="live_times"), tail="GROUP BY region"),
    _gauge("earthquake_sequence_count", "arg_max(eq_count, (time, eq_count))",
           o.since("sequence", "1 hour", of="live_times"), tail="GROUP BY region"),
]), "stream_points", live_times="SELECT event_time AS time FROM live", hourly=HOURLY_POINTS,
    sequence=SEQUENCE_POINTS))(_snapshot)
# Kept by a stream, as of its watermark.
register("stream_replay_gauges", o.sql(" UNION ALL ".join(_EVENT_GAUGES), "stream_points",
    live_times="SELECT date_trunc('milliseconds', max(time)) - INTERVAL 30 SECOND AS time FROM stream_points"))(replay.series)

# --- alerts -----------------------------------------------------------------------------------

HIGH, CRITICAL = alerts.RULES["HighMagnitudeEarthquake"], alerts.RULES["CriticalMagnitudeEarthquake"]
SWARM, SEQUENCE = alerts.RULES["EarthquakeSwarmDetected"], alerts.RULES["EarthquakeSequenceActive"]
ACTIVITY = alerts.RULES["RegionalSeismicActivity"]
_LABELS = ["region", "depth_bin"]


def high_alerts(spark, sf):
    return alerts.firing(metrics.strongest_timeline(stream_points(spark, sf), 6.0), HIGH, _LABELS)


def critical_alerts(spark, sf):
    return alerts.firing(metrics.strongest_timeline(stream_points(spark, sf), 7.0), CRITICAL, _LABELS)


def activity_alerts(spark, sf):
    """The fixture has few events in an hour, so three of them count as activity."""
    return alerts.firing(
        metrics.count_timeline(stream_points(spark, sf), lookback_seconds=3600, at_least=3), ACTIVITY)


def sequence_alerts(spark, sf):
    return alerts.firing(metrics.count_timeline(sequence_points(spark, sf), lookback_seconds=3600), SEQUENCE)


def _fired(ticks: str, rule, keys: str = "region") -> str:
    return o.fired(ticks, keys, rule.hold_seconds, rule.name, rule.severity)


HIGH_SQL = _fired(o.strongest_ticks("stream_points", 6.0), HIGH, "region, depth_bin")
CRITICAL_SQL = _fired(o.strongest_ticks("stream_points", 7.0), CRITICAL, "region, depth_bin")
ACTIVITY_SQL = _fired(o.count_ticks("stream_points", 3600, 3), ACTIVITY)
SEQUENCE_SQL = _fired(o.count_ticks("sequence", 3600, 1), SEQUENCE)

register("alert_high_magnitude", o.sql(HIGH_SQL, "stream_points"))(high_alerts)
register("alert_critical_magnitude", o.sql(CRITICAL_SQL, "stream_points"))(critical_alerts)
# Two events in five minutes instead of three: three of one region are very rare in the fixture.
register("alert_swarm", o.sql(_fired(o.count_ticks("stream_points", 300, 2), SWARM), "stream_points"))(
    over(stream_points, lambda df: alerts.firing(metrics.count_timeline(df, at_least=2), SWARM)))
register("alert_sequence_active", o.sql(SEQUENCE_SQL, "live", sequence=SEQUENCE_POINTS))(sequence_alerts)
register("alert_regional_activity", o.sql(ACTIVITY_SQL, "stream_points"))(activity_alerts)
register("sustained_threshold", o.sql(o.runs(o.count_ticks("stream_points", 1800, 2), "region", 900), "stream_points"))(
    over(stream_points, lambda df: alerts.sustained(
        metrics.count_timeline(df, lookback_seconds=1800, at_least=2), ["region"], 900)))
register("alert_data_gap", o.sql(
    """SELECT 'SeismicDataPipelineDown' AS alertname, 'critical' AS severity,
      gap_start + INTERVAL 300 SECOND AS pending_at,
      CASE WHEN gap_seconds >= 420 THEN gap_start + INTERVAL 420 SECOND END AS firing_at, gap_end AS resolved_at,
      gap_seconds, 'No seismic data updates received for ' ||
        CASE WHEN s >= 86400 THEN (s // 86400) || 'd ' ELSE '' END ||
        CASE WHEN s >= 3600 THEN (s // 3600 % 24) || 'h ' ELSE '' END ||
        CASE WHEN s >= 60 THEN (s // 60 % 60) || 'm ' ELSE '' END || (s % 60) || 's' AS description
    FROM (SELECT *, (epoch_us(gap_end) - epoch_us(gap_start)) / 1e6 AS gap_seconds,
        (epoch_us(gap_end) - epoch_us(gap_start)) // 1000000 AS s
      FROM (SELECT time AS gap_start, lead(time) OVER (ORDER BY time) AS gap_end FROM stream_points)
      WHERE gap_end IS NOT NULL) WHERE gap_seconds > 300""", "stream_points"))(
    over(stream_points, alerts.data_gaps))


# In the middle of the data, between two instants of the grid; runs that hold there are open.
_NOON = "2024-01-15 12:00:02"
register("alert_open_runs", o.sql(
    f"""SELECT region, pending_at, firing_at, CASE WHEN resolved_at <= TIMESTAMP '{_NOON}' THEN resolved_at END AS resolved_at, ticks, peak
    FROM ({o.runs(f"SELECT * FROM ({o.count_ticks('stream_points', 1800, 2)}) WHERE tick <= TIMESTAMP '{_NOON}'", "region", 900)})""",
    "stream_points"))(over(stream_points, lambda df: alerts.sustained(
        metrics.count_timeline(df, lookback_seconds=1800, at_least=2), ["region"], 900, as_of=F.lit(_NOON).cast("timestamp"))))
_GAP_ENDS = "(SELECT max(time) + INTERVAL 10 MINUTE FROM stream_points)"
register("alert_open_silence", o.sql(
    f"""SELECT gap_start + INTERVAL 300 SECOND AS pending_at, gap_end AS resolved_at,
      CASE WHEN gap_seconds >= 420 THEN gap_start + INTERVAL 420 SECOND END AS firing_at, gap_seconds
    FROM (SELECT gap_start, gap_end, (epoch_us(coalesce(gap_end, {_GAP_ENDS})) - epoch_us(gap_start)) / 1e6 AS gap_seconds
      FROM (SELECT time AS gap_start, lead(time) OVER (ORDER BY time) AS gap_end FROM stream_points)) WHERE gap_seconds > 300""",
    "stream_points"))(over(stream_points, lambda df: alerts.data_gaps(
        df, as_of=df.agg(F.max("time") + F.expr("interval 10 minutes")).scalar()).select("pending_at", "resolved_at", "firing_at", "gap_seconds")))


def all_alerts(spark, sf):
    """Alerts of four rules, with the labels all of them have."""
    columns = ["alertname", "severity", "region", "pending_at", "firing_at", "resolved_at", "peak"]
    tables = [f(spark, sf) for f in (high_alerts, critical_alerts, activity_alerts, sequence_alerts)]
    return panels.union(*[
        t.select(*[F.col(c).cast("double") if c == "peak" else F.col(c) for c in columns]) for t in tables
    ])


_ALERT_COLUMNS = "alertname, severity, region, pending_at, firing_at, resolved_at, CAST(peak AS DOUBLE) AS peak"
ALERTS_SQL = {
    "sequence": SEQUENCE_POINTS, "high": HIGH_SQL, "critical": CRITICAL_SQL, "activity": ACTIVITY_SQL,
    "sequences": SEQUENCE_SQL,
    "alerts": " UNION ALL ".join(
        f"SELECT {_ALERT_COLUMNS} FROM {t}" for t in ("high", "critical", "activity", "sequences")),
}
register("alert_groups", o.sql(
    """SELECT alertname, region, CAST(count(*) AS BIGINT) AS n_alerts, min(firing_at) AS first_firing_at,
      max(firing_at) AS last_firing_at, max(resolved_at) AS last_resolved_at, max(peak) AS peak
    FROM alerts GROUP BY 1, 2""", "stream_points", **ALERTS_SQL))(over(all_alerts, alerts.group_alerts))

# With a route for one warning before the others, every arm is taken.
_ROUTES = [({"alertname": "EarthquakeSequenceActive"}, 30, 7200), *alerts.ROUTES]


def _route(*values) -> str:
    """The value of the first route that matches, the last one if none does."""
    tests = [" AND ".join(f"{k} = '{v}'" for k, v in match.items()) for match, _, _ in _ROUTES]
    arms = " ".join(f"WHEN {t} THEN {v}" for t, v in zip(tests, values))
    return f"CAST(CASE {arms} ELSE {values[-1]} END AS INTEGER)"


register("alert_routing", o.sql(
    f"""SELECT alertname, severity, region, firing_at, {_route(*range(len(_ROUTES) + 1))} AS route,
      {_route(*[w for _, w, _ in _ROUTES], alerts.DEFAULT_ROUTE[0])} AS group_wait,
      {_route(*[r for _, _, r in _ROUTES], alerts.DEFAULT_ROUTE[1])} AS repeat_interval
    FROM alerts""", "stream_points", **ALERTS_SQL))(
    over(all_alerts, lambda df: alerts.route(df, _ROUTES).select(
        "alertname", "severity", "region", "firing_at", "route", "group_wait", "repeat_interval")))

_TICKS_SQL = """SELECT {columns}, unnest(generate_series(firing_at, resolved_at - INTERVAL 15 SECOND,
  INTERVAL 15 SECOND)) AS tick FROM {table}"""


def _uninhibited(spark, sf):
    """Activity warnings while no critical alert fires in their region."""
    return alerts.inhibit(activity_alerts(spark, sf), high_alerts(spark, sf), ["region"])


_INHIBITION = """SELECT alertname, severity, region, firing_at, tick FROM targets t
  WHERE NOT EXISTS (SELECT 1 FROM sources s WHERE s.region = t.region AND s.tick = t.tick)"""
_INHIBITION_TABLES = {
    "activity": ACTIVITY_SQL, "high": HIGH_SQL,
    "targets": _TICKS_SQL.format(columns="alertname, severity, region, firing_at", table="activity"),
    "sources": _TICKS_SQL.format(columns="region", table="high"),
}
register("alert_inhibition", o.sql(_INHIBITION, "stream_points", **_INHIBITION_TABLES))(
    over(_uninhibited, lambda df: alerts.part_ticks(df).select("alertname", "severity", "region", "firing_at", "tick")))
register("alert_repeat_suppression", o.sql(
    """SELECT alertname, region, firing_at, CAST(floor((epoch_us(tick) - epoch_us(firing_at)) / 9e8) AS BIGINT) AS repeat,
      min(tick) AS sent_at FROM kept GROUP BY ALL""", "stream_points", **_INHIBITION_TABLES, kept=_INHIBITION))(
    over(_uninhibited, lambda df: alerts.repeat_suppression(df, ["alertname", "region"], 900)))


_NOTES = {
    "action": "CASE alertname WHEN 'HighMagnitudeEarthquake' THEN 'IMMEDIATE RESPONSE REQUIRED - Emergency protocols activated' "
              "WHEN 'CriticalMagnitudeEarthquake' THEN 'HIGHEST PRIORITY - Full emergency response required' END",
    "research_note": "CASE alertname WHEN 'RegionalSeismicActivity' THEN 'Regional activity above normal threshold' "
                     "WHEN 'EarthquakeSequenceActive' THEN 'Sequence detection algorithm triggered - ' || region || ' showing unusual activity' END",
}
register("alert_notes", o.sql(
    f"SELECT alertname, region, firing_at, {_NOTES['action']} AS action, {_NOTES['research_note']} AS research_note FROM alerts",
    "stream_points", **ALERTS_SQL))(over(all_alerts, lambda df: alerts.annotations(df).select(
        "alertname", "region", "firing_at", "action", "research_note")))

# Times to send lie every ten seconds from the first one, so a repeat waits for the next of them.
_SENT_COLUMNS = "alertname, region, severity, group_wait, repeat_interval, firing_at, resolved_at"
_SENT_TABLES = {
    **ALERTS_SQL, "critical_ones": "SELECT * FROM alerts WHERE severity = 'critical'",
    "routed": f"""SELECT *, {_route(*[w for _, w, _ in _ROUTES], alerts.DEFAULT_ROUTE[0])} AS group_wait,
      {_route(*[r for _, _, r in _ROUTES], alerts.DEFAULT_ROUTE[1])} AS repeat_interval FROM alerts WHERE severity = 'warning'""",
    "times": f"""SELECT DISTINCT {_SENT_COLUMNS}, firing_at + INTERVAL 1 SECOND * group_wait AS first,
      unnest(generate_series(firing_at + INTERVAL 1 SECOND * group_wait, resolved_at + INTERVAL 10 SECOND, INTERVAL 10 SECOND)) AS tick FROM routed""",
    "sent": f"""SELECT {_SENT_COLUMNS}, CAST(floor((epoch_us(tick) - epoch_us(first)) / (ceil(repeat_interval / 10) * 1e7)) AS BIGINT) AS repeat,
      min(tick) AS sent_at FROM times t WHERE tick < resolved_at AND NOT EXISTS (
        SELECT 1 FROM critical_ones s WHERE s.region = t.region AND s.firing_at <= tick AND tick < s.resolved_at) GROUP BY ALL""",
}
_SENT_SQL = """SELECT alertname, region, severity, firing_at, 'firing' AS status, repeat, sent_at FROM sent
    UNION ALL SELECT s.alertname, s.region, s.severity, s.firing_at, 'resolved', max(s.repeat),
      (SELECT min(tick) FROM times t WHERE t.alertname = s.alertname AND t.region = s.region AND t.firing_at = s.firing_at AND t.tick >= s.resolved_at)
    FROM sent s GROUP BY s.alertname, s.region, s.severity, s.firing_at, s.resolved_at"""
register("notifications_sent", o.sql(_SENT_SQL, "stream_points", **_SENT_TABLES))(
    over(all_alerts, lambda df: alerts.notifications(
        df.where("severity = 'warning'"), df.where("severity = 'critical'"), F.lit("2034-01-01").cast("timestamp"), ["region"], _ROUTES)))


def _number_text(x: str) -> str:
    return f"CASE WHEN {x} % 1 = 0 THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


register("alert_annotations", o.sql(
    f"""SELECT alertname, region, depth_bin, firing_at, 'HIGH MAGNITUDE EARTHQUAKE DETECTED' AS summary,
      'Earthquake with magnitude ' || {_number_text('peak')} || ' detected in ' || region || ' (depth: ' ||
      depth_bin || ')' AS description FROM high""", "stream_points", high=HIGH_SQL))(
    over(high_alerts, lambda df: df.select(
        "alertname", "region", "depth_bin", "firing_at", F.lit(HIGH.summary).alias("summary"),
        alerts.describe(HIGH, F.col("peak")).alias("description"))))


def payloads(spark, sf):
    """A payload per significant event: one alert above 6, a second one above 7.

    Events without a place carry no region, and those without a depth no annotations.
    """
    df = quakes(spark, sf).where(F.col("mag") > 6.0)
    at = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")

    def alert(rule):
        return F.struct(
            F.lit("firing").alias("status"), at.alias("startsAt"),
            F.create_map(
                F.lit("alertname"), F.lit(rule.name), F.lit("severity"),
                F.when(F.col("latitude").isNotNull(), rule.severity).otherwise("warning"),
                F.lit("region"), F.col("place"),
            ).alias("labels"),
            F.when(F.col("depth").isNotNull(), F.create_map(F.lit("summary"), F.lit(rule.summary))).alias("annotations"),
        )

    both_rules = F.when(F.col("mag") > 7.0, F.array(alert(HIGH), alert(CRITICAL))).otherwise(F.array(alert(HIGH)))
    return df.select(
        F.to_json(F.struct(both_rules.alias("alerts"))).alias("payload"), F.col("event_time").alias("received_at"))


def flat_alerts(spark, sf):
    return alerts.flatten_payloads(payloads(spark, sf))


FLAT_SQL = " UNION ALL ".join(
    f"""SELECT event_time AS received_at, '{rule.name}' AS alertname, 'firing' AS status,
      CASE WHEN latitude IS NOT NULL THEN '{rule.severity}' ELSE 'warning' END AS severity,
      coalesce(place, 'N/A') AS region, CASE WHEN depth IS NULL THEN 'N/A' ELSE '{rule.summary}' END AS summary,
      'N/A' AS description, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS "startsAt", 'N/A' AS "endsAt"
    FROM quakes WHERE mag > {bound}""" for rule, bound in ((HIGH, 6.0), (CRITICAL, 7.0)))
register("alert_payload_flatten", o.sql(FLAT_SQL))(flat_alerts)
register("alert_totals", o.sql(
    """SELECT CAST(count(*) AS BIGINT) AS total_received,
      CAST(count(*) FILTER (severity = 'critical') AS BIGINT) AS critical_alerts,
      CAST(count(*) FILTER (severity = 'warning') AS BIGINT) AS warning_alerts, max(received_at) AS last_alert_time
    FROM flat""", flat=FLAT_SQL))(over(flat_alerts, alerts.totals))
register("alert_history", o.sql(
    """SELECT received_at, alertname, severity, region FROM flat
    ORDER BY received_at DESC, alertname, region LIMIT 20""", flat=FLAT_SQL))(
    over(flat_alerts, lambda df: alerts.history(df, show=20).select(
        "received_at", "alertname", "severity", "region")))

# --- streaming replays ------------------------------------------------------------------------

_SEEN = "(SELECT max(event_time) FROM live) - INTERVAL 30 SECOND"
_CLOSED = f"SELECT * FROM ({{q}}) WHERE window_end <= {_SEEN}"
for _name, _sql in (("hourly_global_stats", o.HOURLY), ("rolling_24h", o.ROLLING_24H), ("depth_pattern_analysis", o.LIVE_DEPTH)):
    register(f"stream_replay_{_name}", o.sql(_CLOSED.format(q=_sql), "live"))(
        lambda spark, sf, n=_name: replay.statistic(spark, sf, n))
# Counts end before their instant and only closed windows are known; a run is over once its end has passed.
register("stream_replay_swarm_rule", o.sql(
    f"""SELECT region, 'pending' AS state, pending_at AS at FROM runs
    UNION ALL SELECT region, 'firing', firing_at FROM runs WHERE firing_at IS NOT NULL
    UNION ALL SELECT region, CASE WHEN firing_at IS NULL THEN 'cleared' ELSE 'resolved' END, resolved_at FROM runs
      WHERE resolved_at <= {_SEEN}""", "live", runs=o.runs(
        f"""SELECT region, make_timestamp(instant) AS tick, CAST(count(*) AS BIGINT) AS value FROM (
          SELECT region, unnest(range(CAST(floor(epoch_us(event_time) / 15e6) AS BIGINT) * 15000000 + 15000000,
            CAST(floor(epoch_us(event_time) / 15e6) AS BIGINT) * 15000000 + 300000001, 15000000)) AS instant FROM live)
        WHERE make_timestamp(instant) <= {_SEEN} GROUP BY ALL HAVING count(*) >= 2""", "region", 60)))(replay.swarm_rule)
# The look-backs of all rules on a stream that is stopped and started again; runs that are over by then.
_OVER = "SELECT {columns} FROM ({q}) WHERE resolved_at <= (SELECT max(time) FROM stream_points) - INTERVAL 30 SECOND"
_RUN = "region, {label} AS depth_bin, pending_at, firing_at, resolved_at, ticks, CAST(peak AS DOUBLE) AS peak, alertname, severity"
for _name, _watch, _sql, _label in (
    ("high", rules.Watch(HIGH, above=6.0), HIGH_SQL, "depth_bin"), ("critical", rules.Watch(CRITICAL, above=7.0), CRITICAL_SQL, "depth_bin"),
    ("activity", rules.Watch(ACTIVITY, 3600, at_least=3), ACTIVITY_SQL, "CAST(NULL AS VARCHAR)"),
):
    register(f"stream_replay_{_name}_rule", o.sql(_OVER.format(columns=_RUN.format(label=_label), q=_sql), "stream_points"))(
        lambda spark, sf, w=_watch: replay.rule(spark, sf, w))
_WARNINGS_SEEN = "(SELECT max(greatest(firing_at, resolved_at)) FROM alerts WHERE severity IN ('warning', 'critical')) - INTERVAL 30 SECOND"
register("stream_replay_notifications", o.sql(f"SELECT * FROM ({_SENT_SQL}) WHERE sent_at <= {_WARNINGS_SEEN}", "stream_points", **_SENT_TABLES))(
    lambda spark, sf: replay.notified(spark, all_alerts(spark, sf), ["region"], _ROUTES))
register("stream_replay_inhibition", o.sql(_INHIBITION, "stream_points", **_INHIBITION_TABLES))(
    lambda spark, sf: alerts.part_ticks(replay.inhibited(spark, activity_alerts(spark, sf), high_alerts(spark, sf).select("region", "firing_at", "resolved_at"), ["region"])).select(
        "alertname", "severity", "region", "firing_at", "tick"))
_USABLE = "SELECT id, event_time, mag FROM live"
register("live_late_events", o.sql(_USABLE, "live"))(replay.late_events)
register("live_restart", o.sql(_USABLE, "live"))(replay.restarted)
register("live_corrected_hours", o.sql(o.HOURLY, "live"))(replay.corrected)
# Windows that had closed before the late events came: the watermark is that of the others.
_BEFORE = "(SELECT max(event_time) FROM live WHERE CAST(id AS INTEGER) % 10 <> 3) - INTERVAL 30 SECOND"
for _name, _sql, _columns in (
    ("rolling_24h", o.ROLLING_24H, "window_start AS \"window\", min_event_time AS time, region, eq_count, avg_mag, max_mag"),
    ("realtime_magnitude_distribution", o.LIVE_MAGNITUDE, "window_start AS \"window\", min_event_time AS time, mag_bin, eq_count"),
):
    register(f"live_corrected_{_name}", o.sql(f"SELECT {_columns} FROM ({_sql}) WHERE window_end <= {_BEFORE}", "live"))(
        lambda spark, sf, n=_name: replay.corrected_statistic(spark, sf, n).select(
            "window", "time", *(["region", "eq_count", "avg_mag", "max_mag"] if n == "rolling_24h" else ["mag_bin", "eq_count"])))
register("stream_replay_dedupe", o.sql("SELECT id, mag, region FROM live", "live"))(replay.deduplicated)

assert set(_STORED) == {m.removesuffix("_stream") for m in MEASUREMENTS}

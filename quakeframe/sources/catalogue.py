"""Catalogue scans: header CSV, time ranges and the look-back of a scheduled job."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quakeframe.schema import CATALOGUE_CSV

MIN_MAGNITUDE = 4.0


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = CATALOGUE_CSV
) -> DataFrame:
    """All columns as text, pruned to those used.

    The header is checked against the schema. With ``schema=None`` the names come from the
    header, for files that have other columns or another order.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


RECORD, FILE, BLOCK = "record", "file", "block"


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether some line has a quote that it does not close, so that its record goes on in the next one."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_records(spark: SparkSession, path: str, schema: StructType = CATALOGUE_CSV) -> DataFrame:
    """All records, also those that do not have the fields of the schema, with where they come from.

    A record with too few or too many fields keeps its text as ``record``, which is null for all others;
    ``file`` and ``block`` (the byte at which the reading task began in it) tell where to look for it. Lines
    are told from records: a quoted line break belongs to its field. Files are split among tasks unless
    one has such a line break; then each file is read by one task.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
    reader = reader.schema(StructType([*schema, StructField(RECORD, StringType())])).option("columnNameOfCorruptRecord", RECORD)
    # Whether a record has all fields is known only where all of them are parsed.
    rows = reader.option("columnPruning", False).option("multiLine", spans_lines(spark, path)).csv(path)
    return rows.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def time_range(
    start: str | None = None, end: str | None = None, delta_seconds: int | None = None,
    now: datetime | None = None,
) -> tuple[datetime, datetime]:
    """Explicit bounds win; otherwise the last ``delta_seconds`` before ``now``. Both are UTC, without a zone."""
    if start and end:
        return utc(start).replace(tzinfo=None), utc(end).replace(tzinfo=None)
    if delta_seconds is None:
        raise ValueError("give start and end, or delta_seconds")
    stop = utc(now or datetime.now(timezone.utc)).replace(tzinfo=None)
    return stop - timedelta(seconds=int(delta_seconds)), stop


def has_date(df: DataFrame) -> bool:
    return ("date", "date") in df.dtypes


def as_of_column(df: DataFrame, time: str = "event_time") -> Column:
    """The latest time in a table, as a scalar subquery.

    It aggregates map-side and is a literal for the scan that uses it. Of a table kept by date only
    the last folder is opened, which the listing of its files tells. Where rows were filtered out that
    folder need not have any left, so there the last day is looked up among the rows.
    """
    if not has_date(df):
        return df.agg(F.max(time)).scalar()
    days = re.findall(r"/date=(\d{4}-\d{2}-\d{2})/", "\n".join(df.inputFiles()))
    whole = days and not re.search(r"Filter|Limit|Join|Aggregate|Sample", df._jdf.queryExecution().analyzed().toString())
    last = F.lit(max(days)).cast("date") if whole else df.agg(F.max("date")).scalar()
    return df.where(F.col("date") == last).agg(F.max(time)).scalar()


_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def utc(value: str | datetime) -> datetime:
    """An instant with its zone; one without a zone is UTC, whatever the zone of this machine."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def _instant(value):
    """A column as it is; a text or a ``datetime`` as a literal that no session or machine zone shifts."""
    if not isinstance(value, (str, datetime)):
        return value
    return F.timestamp_micros(F.lit((utc(value) - _EPOCH) // timedelta(microseconds=1)))


def range_scan(
    df: DataFrame, start, end, min_magnitude: float = MIN_MAGNITUDE, ordered: bool = True,
) -> DataFrame:
    """Events between two instants (both included) with at least a magnitude, oldest first."""
    time = F.col("event_time")
    out = df.where(
        (time >= _instant(start)) & (time <= _instant(end)) & (F.col("mag") >= min_magnitude)
    )
    return out.orderBy("event_time", "id") if ordered else out


def lookback_scan(df: DataFrame, delta_seconds: int, as_of=None, **options) -> DataFrame:
    """The last seconds before ``as_of``, by default before the latest event."""
    end = _instant(as_of) if as_of is not None else as_of_column(df)
    return range_scan(df, end - F.make_dt_interval(secs=F.lit(delta_seconds)), end, **options)

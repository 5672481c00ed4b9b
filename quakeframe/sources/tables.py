"""Tables in parquet and CSV files."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.sources.catalogue import _instant, has_date


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """A header in every part file. One file only on request: it takes one task to write."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def write_by_date(df: DataFrame, path: str, time: str = "time", mode: str = "overwrite") -> None:
    """Parquet under one folder per day.

    The rebalance hint gathers each day into few files and lets AQE split a day that is too
    large for one task. Within a file rows are in time order, so that ranges of hours skip row
    groups; the writer needs a sort by day anyway. Only days present are replaced when overwriting.
    """
    dated = df if "date" in df.columns else df.withColumn("date", F.to_date(time))
    (
        dated.hint("rebalance", "date")
        .sortWithinPartitions("date", time)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder, in whatever store it lies; a missing one is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder, which need not exist."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in store.listStatus(folder)] if store.exists(folder) else []


def days_of(spark: SparkSession, path: str) -> list[str]:
    """The days of a table kept by date, newest first: one listing of its folder, no file is opened."""
    found = (re.fullmatch(r"date=(\d{4}-\d{2}-\d{2})", name) for name in names_in(spark, path))
    return sorted((m.group(1) for m in found if m), reverse=True)


def newest(df: DataFrame, days: Sequence[str], n: int, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` of the newest days that have ``n`` of them together, or of all days if they have fewer.

    Goes back from the newest day, twice as many days each time, and counts no more than are still missing;
    so a search for the latest of a year opens a day or two. Rows of one day are later than those of the days
    before, so the ``n`` latest rows of the table, whatever the ties, are among the result.
    """
    at, span, have = 0, 1, 0
    while at < len(days) and have < n:
        last = min(len(days), at + span) - 1
        have += rows(df.where(F.col("date").between(F.lit(days[last]).cast("date"), F.lit(days[at]).cast("date")))).limit(n - have).count()
        at, span = last + 1, 2 * span
    return rows(df.where(F.col("date") >= F.lit(days[at - 1]).cast("date")) if at else df)


def range_filter(df: DataFrame, start=None, stop=None, time: str = "time") -> DataFrame:
    """Half open: start included, stop not. Prunes the ``date`` folders where there are any."""
    out = df
    dated = has_date(df)
    if start is not None:
        out = out.where(F.col(time) >= _instant(start))
        if dated:
            out = out.where(F.col("date") >= F.to_date(_instant(start)))
    if stop is not None:
        out = out.where(F.col(time) < _instant(stop))
        if dated:
            out = out.where(F.col("date") <= F.to_date(_instant(stop)))
    return out


def read_points(spark: SparkSession, path: str, start=None, stop=None) -> DataFrame:
    return range_filter(spark.read.parquet(path), start, stop)

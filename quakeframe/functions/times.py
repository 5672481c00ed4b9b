"""Time parsing, calendar parts and period starts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LAST_MILLIS = 253_402_300_799_999  # 9999-12-31T23:59:59.999Z
_ZONED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}(:?\d{2})?)$"
_LIVE = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}Z$"


def parse_catalogue_time(text: Column) -> Column:
    """Epoch milliseconds when all digits, else an ISO instant with a zone; null if neither."""
    millis = text.try_cast("bigint")
    epoch = F.when(millis <= F.lit(_LAST_MILLIS), F.timestamp_millis(millis))
    iso = F.when(
        text.rlike(_ZONED),
        F.coalesce(
            text.try_cast("timestamp"),
            F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]X")),
        ),
    )
    return F.when(text.rlike(r"^\d+$"), epoch).otherwise(iso)


def parse_live_time(text: Column) -> Column:
    """Only ``yyyy-MM-ddTHH:mm:ss.f{1,6}Z``; anything else is null."""
    return F.when(text.rlike(_LIVE), text.try_cast("timestamp"))


def calendar_parts(time: Column) -> dict[str, Column]:
    """Calendar year with ISO week, as the statistics group by both."""
    return {
        "year": F.year(time),
        "month": F.month(time),
        "week": F.weekofyear(time),
        "date": F.to_date(time),
    }


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1)).cast("timestamp")


def iso_week_start(year: Column, week: Column) -> Column:
    """Monday of an ISO week. January 4th always lies in week 1."""
    first = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4)))
    return F.date_add(first.cast("date"), ((week - 1) * 7).cast("int")).cast("timestamp")


def iso_year(time: Column) -> Column:
    """The year an ISO week belongs to: that of its Thursday."""
    return F.year(F.date_add(F.date_trunc("week", time).cast("date"), 3))


def iso_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def shift(time: Column, whole_seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(time) + F.lit(int(whole_seconds) * 1_000_000))


def shift_days(time: Column, days: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(time) + days.cast("bigint") * 86_400_000_000)


def floor_to(time: Column, width_seconds: int) -> Column:
    """Start of the epoch-aligned bucket a time falls in."""
    width = F.lit(int(width_seconds) * 1_000_000)
    micros = F.unix_micros(time)
    return F.timestamp_micros(micros - F.pmod(micros, width))


def humanize_seconds(secs: Column) -> Column:
    """``1h 2m 3s``: the largest non-zero unit first, whole seconds."""
    s = F.floor(secs).cast("bigint")
    days, hours = F.floor(s / 86400), F.floor(F.pmod(s, F.lit(86400)) / 3600)
    minutes, rest = F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    day, hour = F.format_string("%dd", days), F.format_string("%dh", hours)
    minute, second = F.format_string("%dm", minutes), F.format_string("%ds", rest)
    return (
        F.when(days > 0, F.concat_ws(" ", day, hour, minute, second))
        .when(hours > 0, F.concat_ws(" ", hour, minute, second))
        .when(minutes > 0, F.concat_ws(" ", minute, second))
        .otherwise(second)
    )

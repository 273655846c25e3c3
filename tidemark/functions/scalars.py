"""Scalar column functions. All times are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_SECOND = 1000
MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000


def _whole(value: Column, unit: int) -> Column:
    """Whole units in an integer; rounds down."""
    return F.call_function("div", value - F.pmod(value, F.lit(unit)), F.lit(unit).cast("bigint"))


def lower_split(text: Column) -> Column:
    """Lower-cased tokens between runs of non-word characters.

    Trailing empty tokens are dropped and a leading one is kept, as
    ``java.lang.String.split`` does.
    """
    parts = F.split(F.lower(text), r"\W+")
    return F.filter(
        parts,
        lambda token, i: (token != "")
        | ((i == 0) & ((F.size(parts) == 1) | (F.get(parts, F.lit(1)) != ""))),
    )


def concat_all(items: Column, separator: str = "") -> Column:
    return F.array_join(items, separator)


def message(template: str, *values: Column) -> Column:
    """Text rendered from a printf template."""
    return F.format_string(template, *values)


def contains(text: Column, part: str) -> Column:
    return F.instr(text, part) > 0


def differs_by_more(a: Column, b: Column, limit: float) -> Column:
    return F.abs(a - b) > limit


def smaller(*values: Column) -> Column:
    return F.least(*values)


def larger(*values: Column) -> Column:
    return F.greatest(*values)


def fahrenheit_to_celsius(degrees: Column) -> Column:
    return (degrees - 32) * (5.0 / 9.0)


def recode_containing(name: Column, part: str, replacement: str) -> Column:
    """``replacement`` where the name contains ``part``, else the name."""
    return F.when(contains(name, part), F.lit(replacement)).otherwise(name)


def part_of_day(epoch_seconds: Column) -> Column:
    """morning [4,12), day [12,17), evening [17,24), otherwise night."""
    hour = F.pmod(_whole(epoch_seconds, 3600), F.lit(24))
    return (
        F.when((hour >= 4) & (hour < 12), "morning")
        .when((hour >= 12) & (hour < 17), "day")
        .when(hour >= 17, "evening")
        .otherwise("night")
    )


def date_from_seconds(epoch_seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(epoch_seconds))


def parse_date_time(day: Column, time: Column) -> Column:
    """``dd/MM/yyyy`` and ``HH:mm:ss`` as epoch milliseconds."""
    stamp = F.to_timestamp(F.concat_ws("|", day, time), "dd/MM/yyyy'|'HH:mm:ss")
    return F.unix_millis(stamp)


def parse_hms(duration: Column) -> Column:
    """``H:mm:ss`` as milliseconds; hours may exceed 23."""
    parts = F.split(duration, ":")
    hours, minutes, seconds = (F.element_at(parts, i).cast("bigint") for i in (1, 2, 3))
    return (hours * 3600 + minutes * 60 + seconds) * MS_PER_SECOND


def end_time(start_ms: Column, duration_ms: Column) -> Column:
    return start_ms + duration_ms


def seconds_of_day(epoch_ms: Column) -> Column:
    return _whole(F.pmod(epoch_ms, F.lit(MS_PER_DAY)), MS_PER_SECOND).cast("int")


def format_hms(seconds: Column) -> Column:
    """Seconds of a day as ``HH:mm:ss``."""
    return F.date_format(F.timestamp_seconds(seconds), "HH:mm:ss")


def weekday_name(epoch_ms: Column) -> Column:
    """English day name in capitals."""
    return F.upper(F.date_format(F.timestamp_millis(epoch_ms), "EEEE"))


def to_seconds(duration_ms: Column) -> Column:
    return _whole(duration_ms, MS_PER_SECOND)


def to_hours(duration_ms: Column) -> Column:
    return duration_ms / float(MS_PER_HOUR)


def parse_instant(text: Column) -> Column:
    """ISO-8601 text as a timestamp."""
    return F.to_timestamp(text)


def format_instant(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def deadline(ts: Column, seconds: int) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(seconds))


def before(a: Column, b: Column) -> Column:
    return a < b

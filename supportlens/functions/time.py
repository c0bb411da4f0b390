"""Time columns. All timestamps are zone-less UTC wall clock, so no result hangs on the session zone."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions.text import col

def ntz(value: date | datetime | str) -> Column:
    """A wall clock as a literal. A datetime goes by its text, since Spark would read it in the session's zone."""
    return F.lit(str(value) if isinstance(value, datetime) else value).cast("timestamp_ntz")


def to_utc(local: Column | str, zone: str = values.SOURCE_ZONE) -> Column:
    """UTC of a local wall clock. The hour a clock change repeats counts as standard time."""
    local = col(local)
    early = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    late = early + F.expr("interval '1' hour")
    return F.when(F.convert_timezone(F.lit("UTC"), F.lit(zone), late) == local, late).otherwise(early)


def from_utc(utc: Column | str, zone: str = values.SOURCE_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(utc))


def source_text_to_utc(text: Column | str, zone: str = values.SOURCE_ZONE) -> Column:
    """'2020-04-09T13:13:42Z' is local time in the source, whatever its Z says."""
    wall = F.regexp_extract(col(text), r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})Z$", 1)
    return to_utc(wall.try_cast("timestamp_ntz"), zone)


def survey_text_to_utc(text: Column | str, observed: bool = False) -> Column:
    """'2019-07-13 23:49:22 EDT' to UTC; null where it does not parse.

    observed=True returns the wall clock itself, which is what the source system stores.
    """
    text = col(text)
    shape = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \S+$"
    wall = F.regexp_extract(text, shape, 1).try_cast("timestamp_ntz")
    if observed:
        return wall
    east = F.when(text.endswith(" EST"), F.expr("interval '5' hour")).when(text.endswith(" EDT"), F.expr("interval '4' hour"))
    return wall + east.otherwise(F.expr("interval '0' hour"))


def survey_watermark_text(utc: Column | str) -> Column:
    """Watermark as the survey API wants it: Eastern wall clock, blanks as plus signs."""
    return F.date_format(from_utc(utc, values.SURVEY_ZONE).cast("timestamp_ntz"), "yyyy-MM-dd+HH:mm:ss")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, truncated toward zero."""
    gap = col(end) - col(start)
    whole = [F.extract(F.lit(unit), gap) * size for unit, size in (("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60))]
    return whole[0].cast("long") + whole[1] + whole[2] + F.extract(F.lit("SECOND"), gap).cast("long")


def compact_date(text: Column | str) -> Column:
    """'20200409' to a date, null where it does not parse."""
    parts = F.regexp_replace(col(text), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return parts.try_cast("date")


def week_start(day: Column | str) -> Column:
    """Monday of the day's week."""
    return F.trunc(col(day).cast("date"), "week")


def month_first(day: Column | str) -> Column:
    return F.trunc(col(day), "MM")


def month_last(day: Column | str) -> Column:
    return F.last_day(col(day))


def settled(day: Column | str, today: date, days: int = values.SETTLING_DAYS) -> Column:
    """Days old enough to be final: end is today minus the lag, exclusive."""
    return col(day).cast("date") < F.lit(today - timedelta(days=days))


def date_range(spark: SparkSession, start: date, end: date, name: str = "day") -> DataFrame:
    """One row a day, half-open [start, end)."""
    days = max((end - start).days, 0)
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def collection_week(today: date, last_update: date | None) -> tuple[date, date] | None:
    """[Monday a week ago, Monday of this week), or None when that week is already in."""
    end = today - timedelta(days=today.weekday())
    return None if last_update == end else (end - timedelta(days=7), end)


def parse_bound(text: str) -> datetime:
    """A date or date-time given by a user; anything else is an error that names it."""
    try:
        return datetime.fromisoformat(text)
    except ValueError as err:
        raise ValueError(f"not a valid date: {text!r}") from err

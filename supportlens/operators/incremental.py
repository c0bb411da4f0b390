"""The load contract: high-water marks, range scans, and what to load next."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.functions.time import from_utc, ntz
from supportlens.operators.skew import first_by


def watermark(df: DataFrame, column: str, default: Any = None) -> DataFrame:
    """One row, `watermark`: the greatest value loaded so far, or the default when there is none."""
    top = F.max(column)
    if default is not None:
        top = F.coalesce(top, F.lit(default).cast(df.schema[column].dataType))
    return df.agg(top.alias("watermark"))


def watermark_by(df: DataFrame, by: str, column: str) -> DataFrame:
    """The same for every product at once."""
    return df.groupBy(by).agg(F.max(column).alias("watermark"))


def source_day(df: DataFrame, column: str) -> DataFrame:
    """One row, `start`: the source-zone day of the greatest UTC timestamp."""
    return df.agg(from_utc(F.max(column)).cast("date").alias("start"))


def read_watermark(df: DataFrame | None, column: str, default: Any = None) -> Any:
    """The watermark as a driver value; a missing table counts as empty."""
    return default if df is None else watermark(df, column, default).first()["watermark"]


def within(df: DataFrame, ts: str, start: Any, end: Any, ends: str) -> DataFrame:
    """Rows between two times; ends says which bounds belong: '(]' or '[)'. Tables stored by day list only its days.
    Without a start everything up to the end counts, rows without a time too."""
    high, at = ntz(end), F.col(ts)
    if start is None:
        if f"{ts}_day" in df.columns:
            day = F.col(f"{ts}_day")
            df = df.where(day.isNull() | (day <= high.cast("date")))
        return df.where(at.isNull() | (at <= high if ends == "(]" else at < high))
    low = ntz(start)
    if f"{ts}_day" in df.columns:
        df = df.where(F.col(f"{ts}_day").between(low.cast("date"), high.cast("date")))
    return df.where((at > low) & (at <= high) if ends == "(]" else (at >= low) & (at < high))


def scan_range(
    df: DataFrame, ts: str, start: Any, end: Any, limit: int | None = None, ordered: bool = True
) -> DataFrame:
    """Rows after start up to end, oldest first. A load that only appends should pass ordered=False.

    With a limit, as many of the oldest rows and all further ones of the last one's time, so that a next scan from that
    time on misses none."""
    rows = within(df, ts, start, end, "(]")
    if limit is not None:
        last = rows.select(ts).orderBy(F.col(ts).asc_nulls_first()).limit(limit).agg(F.max(ts)).scalar()
        rows = rows.where(F.col(ts).isNull() | (F.col(ts) <= last))
    return rows.orderBy(ts) if ordered else rows


def scan_days(df: DataFrame, ts: str, start: date, end: date, columns: Sequence[str]) -> DataFrame:
    """[start, end) with its day in `day`: one scan in place of one query a day."""
    return within(df, ts, start, end, "[)").select(F.to_date(ts).alias("day"), *columns)


def scan_submitted(df: DataFrame, ts: str, end: datetime, start: datetime | None = None) -> DataFrame:
    """Half-open [start, end), by default the day before end."""
    start = end - timedelta(days=1) if start is None else start
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return within(df, ts, start, end, "[)")


def next_window(start: date, end: date, loaded: date | None) -> tuple[date, date] | None:
    """What of [start, end) is still to load after day `loaded`; None when nothing is."""
    if loaded is not None:
        if end <= loaded:
            return None
        if start <= loaded:
            start = loaded + timedelta(days=1)
    return None if start >= end else (start, end)


def since(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows past a watermark, all of them without one."""
    if value is None:
        return df
    return df.where(F.col(column) > (ntz(value) if isinstance(value, datetime) else F.lit(value)))


def id_range(df: DataFrame, column: str) -> DataFrame:
    """Least and greatest id of a batch, which name its file."""
    return df.agg(F.min(column).alias("min_id"), F.max(column).alias("max_id"))


def new_rows(batch: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose keys are not loaded yet, one row a key: a second run adds nothing, and no key comes twice.
    Of rows that share a key, the one with the least hash of all its columns stays. Nulls are keys like others."""
    once = first_by(batch, keys, [F.xxhash64(*batch.columns)])
    known = loaded.select(*[F.col(k).alias(f"_loaded_{k}") for k in keys])
    return once.join(known, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_loaded_{k}")) for k in keys]), "left_anti")


def replace_months(table: DataFrame, batch: DataFrame, ts: str) -> DataFrame:
    """The table after each month the batch touches is replaced by the batch's rows."""
    month: Column = F.trunc(F.col(ts).cast("date"), "MM")
    touched = batch.select(month.alias("_month")).distinct()
    kept = table.withColumn("_month", month).join(touched, "_month", "left_anti").drop("_month")
    return kept.unionByName(batch)

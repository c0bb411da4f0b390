"""Database mirror: one conforming step for all tables, range-cut extracts, the votes view."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions.cast import safe_cast
from supportlens.functions.text import escape_newlines
from supportlens.functions.time import ntz, to_utc
from supportlens.schemas import MIRROR, mirror_kinds


def conform(df: DataFrame, table: str, compat: bool = False, zone: str = values.SOURCE_ZONE) -> DataFrame:
    """Rows of a source table, columns by position, as its typed mirror."""
    kinds = mirror_kinds(MIRROR[table])
    if len(df.columns) != len(kinds):
        raise ValueError(f"{table}: {len(kinds)} columns expected, {len(df.columns)} found")
    named = df.toDF(*[name for name, _ in kinds])
    return named.select(*[_convert(named, name, kind, compat, zone).alias(name) for name, kind in kinds])


def _convert(df: DataFrame, source: str, kind: str, compat: bool, zone: str) -> Column:
    if kind == "utc":
        return to_utc(F.col(source).try_cast("timestamp_ntz"), zone)
    if kind == "date":
        return F.col(source).try_cast("date")
    if kind == "text":
        return escape_newlines(safe_cast(df, source, "str", compat), carriage_returns=True)
    if kind == "int!":
        value = safe_cast(df, source, "int", compat)
        shown = F.coalesce(F.col(source).cast("string"), F.lit("null"))
        return F.coalesce(value, F.raise_error(F.concat(F.lit(f"{source} is no whole number: "), shown)))
    return safe_cast(df, source, kind, compat)


#: A day or wall clock as text or value, or a number.
Cut = str | date | datetime | int | float


def balanced_cuts(df: DataFrame, column: str, ranges: int, accuracy: int = 100) -> tuple[Cut | None, list[Cut]]:
    """The column's greatest value and the rising cuts, at most ranges - 1, that part its rows into near equal ranges.

    Both come from one aggregate: the watermark of a stored table and the cuts for the next extract of its source need one pass and no
    sort. The quantile sketch merges over tasks in bounded memory; a range's size is off by at most two parts in `accuracy` of the
    mean. A value is never split: one that holds more than a range's share is the end of a larger range.
    """
    shares = [k / ranges for k in range(1, ranges)]
    sketch = F.percentile_approx(column, shares or [0.5], accuracy * ranges)
    greatest, cuts = df.agg(F.max(column), sketch).first()
    return greatest, sorted({c for c in cuts or [] if c < greatest}) if shares else []


def _in_sql(cut: Cut) -> str:
    return str(cut) if isinstance(cut, (int, float)) else f"'{cut}'"


def range_predicates(column: str, cuts: Sequence[Cut] = tuple(values.VOTE_CUTS)) -> list[str]:
    """SQL conditions that cut a table at the given days or values into disjoint ranges; rows without a value are the last one."""
    if not cuts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    shown = [_in_sql(cut) for cut in cuts]
    bounds = [f"{column} <= {shown[0]}"]
    bounds += [f"{column} > {low} AND {column} <= {high}" for low, high in zip(shown, shown[1:])]
    return [*bounds, f"{column} > {shown[-1]}", f"{column} IS NULL"]


def range_chunks(df: DataFrame, column: str, cuts: Sequence[Cut] = tuple(values.VOTE_CUTS)) -> DataFrame:
    """All rows with the number of their range in `chunk`, from one scan; rows without a value have the last number."""
    cases = F.when(F.col(column).isNull(), len(cuts) + 1)
    for number, cut in enumerate(cuts):
        cases = cases.when(F.col(column) <= (F.lit(cut) if isinstance(cut, (int, float)) else ntz(cut)), number)
    chunk = cases.otherwise(len(cuts))
    return df.withColumn("chunk", chunk)


def votes_by_document(votes: DataFrame, revisions: DataFrame, documents: DataFrame, until: str) -> DataFrame:
    """Votes up to a day with the document they are about: vote to revision to document."""
    early = votes.where(F.col("created") <= ntz(until))
    voted = early.join(revisions.select(F.col("id").alias("revision_id"), "document_id"), "revision_id")
    titles = documents.select(F.col("id").alias("document_id"), "title", "locale")
    return voted.join(titles, "document_id").select("document_id", "title", "locale", "created", "helpful")

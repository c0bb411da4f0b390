"""Release calendar: each release's days from weeks before to weeks after."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions.cast import parse_long

RECORD = (
    "struct<product: string, category: string, build_number: bigint, date: string, version: string, "
    "description: string, is_security_driven: boolean>"
)


def release_rows(documents: DataFrame, json: str = "value") -> DataFrame:
    """Documents whose `releases` map names to records, one row a release."""
    releases = F.from_json(json, f"releases map<string, {RECORD}>")["releases"]
    return documents.select(F.explode(releases).alias("release", "record")).select("release", "record.*")


def release_calendar(
    releases: DataFrame,
    weeks_before: int = values.CALENDAR_WEEKS_BEFORE,
    weeks_after: int = values.CALENDAR_WEEKS_AFTER,
    min_major: int | None = values.CALENDAR_MIN_MAJOR,
) -> DataFrame:
    """One row a day around each release. The release day is day 1 of week 1, the day before day 0 of week 0."""
    day = F.col("date").cast("date")
    if min_major is not None:
        releases = releases.where(parse_long(F.split("version", r"\.")[0]) >= min_major)
    offsets = F.sequence(F.lit(-7 * weeks_before), F.lit(7 * weeks_after - 1))
    return releases.withColumn("_offset", F.explode(offsets)).select(
        "release",
        "product",
        "category",
        "build_number",
        day.alias("release_date"),
        "version",
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("is_security_driven", F.lit(False)).alias("is_security_driven"),
        F.date_add(day, F.col("_offset")).alias("date_utc"),
        (F.col("_offset") + 1).cast("long").alias("day_num"),
        (F.floor(F.col("_offset") / 7) + 1).cast("long").alias("week_num"),
    )

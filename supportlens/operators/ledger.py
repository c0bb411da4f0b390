"""A ledger of loaded ranges of days: what is loaded, what is due, and which days got rows since.

A watermark knows one greatest value; what is missing behind it stays missing. The ledger has a row (low, high, as_of) for each load: the days
from `low` up to before `high`, with all rows that had arrived by `as_of`. A day is due if no load covers it, or if rows of it have
arrived since the last load that does. Due days are loaded whole and replaced, so that a load that failed in the middle and late rows end in
the same table as one clean load.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEDGER = "low date, high date, as_of timestamp_ntz"


def merged_ranges(ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, low, high of the ranges [low, high) joined where they overlap or touch. Empty ranges and ranges without a bound count for nothing."""
    rows = ranges.where("low < high").select(*by, "low", "high")
    order = Window.partitionBy(*by).orderBy("low", "high")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = rows.withColumn("_begun", F.when(before.isNull() | (F.col("low") > before), F.col("low")))
    island = begun.withColumn("_island", F.max("_begun").over(order))
    return island.groupBy(*by, "_island").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_island")


def missing_ranges(ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, low, high of the holes between the ranges: from the end of one to the beginning of the next."""
    whole = merged_ranges(ranges, by)
    order = Window.partitionBy(*by).orderBy("low")
    return whole.select(*by, F.col("high").alias("low"), F.lead("low").over(order).alias("high")).where("high is not null")


def covered_days(ledger: DataFrame) -> DataFrame:
    """day, as_of of the last load of each day."""
    days = ledger.where("low < high").select(F.explode(F.sequence("low", F.date_sub("high", 1))).alias("day"), "as_of")
    return days.groupBy("day").agg(F.max("as_of").alias("as_of"))


def due_days(rows: DataFrame, ledger: DataFrame, ts: str, arrived: str) -> DataFrame:
    """day of the rows that no load covers, or that arrived after the last load of their day. Rows without a time belong to no day."""
    days = rows.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.max(arrived).alias("last"))
    met = days.join(covered_days(ledger), "day", "left")
    return met.where(F.col("as_of").isNull() | (F.col("last") > F.col("as_of"))).select("day")


def as_ranges(days: Sequence[date]) -> list[tuple[date, date]]:
    """Days as ranges [low, high)."""
    ranges: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if ranges and ranges[-1][1] == day:
            ranges[-1] = (ranges[-1][0], day + timedelta(days=1))
        else:
            ranges.append((day, day + timedelta(days=1)))
    return ranges


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def load_due(
    rows: DataFrame, make: Callable[[DataFrame], DataFrame], target: str, ledger: str, as_of: datetime, ts: str, arrived: str
) -> list[date]:
    """Loads the due days of the rows that had arrived by `as_of`: `make` turns a day's rows into rows with the column `day`, which replace what
    `target` has of it. Tells the days. The ledger is written last, so that a load that failed is due again."""
    spark = rows.sparkSession
    there = rows.where(F.col(arrived) <= F.lit(as_of).cast("timestamp_ntz"))
    due = sorted(r["day"] for r in due_days(there, read_ledger(spark, ledger), ts, arrived).collect())  # days, not rows
    if due:
        made = make(there.where(F.to_date(ts).isin(due)))
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(target)
        spark.createDataFrame([(low, high, as_of) for low, high in as_ranges(due)], LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    return due

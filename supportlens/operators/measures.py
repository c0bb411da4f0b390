"""Weekly measures the support dashboard shows of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supportlens.functions.time import week_start


def weekly_shares(df: DataFrame, day: str, category: str) -> DataFrame:
    """Rows of each category a week and their share of the week (sentiment, satisfaction)."""
    counts = df.groupBy(week_start(day).alias("week"), category).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("week")))


def weekly_change(df: DataFrame, day: str, by: list[str], amount: Column) -> DataFrame:
    """Weekly totals and their change in percent from the week before; null without one."""
    weeks = df.groupBy(*by, week_start(day).alias("week")).agg(F.sum(amount).alias("total"))
    before = Window.partitionBy(*by).orderBy("week")
    previous = F.when(F.lag("week").over(before) == F.date_sub("week", 7), F.lag("total").over(before))
    return weeks.withColumn("change_pct", (F.col("total") - previous) / previous * 100)


def click_through(report: DataFrame) -> DataFrame:
    """Share of searchers who clicked a result, a day."""
    users = {name: F.sum(F.when(F.col("ga_segment") == name, F.col("ga_users"))) for name in ("Result Clicked", "Search")}
    return report.groupBy("ga_date").agg((users["Result Clicked"] / users["Search"]).alias("click_share"))

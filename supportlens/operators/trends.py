"""Search trends: rising queries and their hourly series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions.text import composite_key


def with_regions(terms: DataFrame, regions: Sequence[str] = tuple(values.TREND_REGIONS)) -> DataFrame:
    """Each search term in each region of the report."""
    return terms.withColumn("region", F.explode(F.array(*[F.lit(r) for r in regions])))


def translate(queries: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Adds translated_query from a dictionary (original_query, translated_query), the least of several; the original
    where it has none."""
    known = dictionary.groupBy("original_query").agg(F.min("translated_query").alias("_translated"))
    joined = queries.join(known, "original_query", "left")
    return joined.withColumn("translated_query", F.coalesce("_translated", "original_query")).drop("_translated")


def rising_queries(queries: DataFrame, end: date, dictionary: DataFrame) -> DataFrame:
    """Rows (region, query, value) of the trend source to the rising-queries table."""
    named = queries.withColumnsRenamed({"value": "search_increase_pct", "query": "original_query"})
    keyed = named.select(
        F.lit(end).alias("update_date"),
        "region",
        "original_query",
        composite_key(F.lit(end), "region", "original_query").alias("query_key_ts"),
        F.col("search_increase_pct").cast("long").alias("search_increase_pct"),
    )
    return translate(keyed, dictionary).select(
        "update_date", "region", "original_query", "translated_query", "query_key_ts", "search_increase_pct"
    )


def query_series(wide: DataFrame, end: date, queries: Sequence[str]) -> DataFrame:
    """Frames of one column a query (region, date, isPartial, <query>…) to one row a query and hour."""
    kept = wide.drop("isPartial")
    long = kept.unpivot(["region", "date"], list(queries), "original_query", "relative_search_volume")
    return long.where("relative_search_volume is not null").select(
        composite_key(F.lit(end), "region", "original_query").alias("query_key"),
        F.col("date").alias("timestamp"),
        "original_query",
        F.col("relative_search_volume").cast("long").alias("relative_search_volume"),
    )

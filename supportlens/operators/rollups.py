"""Distinct users that add up: a daily rollup of bitmaps, merged over any days and dimensions without the hits.

Users get dense numbers once, kept in a table that new users are appended to. A day's users are then bits in bitmaps of 32768, one row for each
bucket of numbers; weeks, months and coarser dimensions are their bit-wise or. Counts are exact. A hot page or country costs no more than
any other: hits are brought together within their task before they move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places that the numbers are given out in, independently of each other.
PLACES = 4096


def new_codes(hits: DataFrame, known: DataFrame | None, user: str = "user_id") -> DataFrame:
    """user, code of the users of `hits` that `known` (user, code) hasn't: the next free numbers of the place that the user's hash
    names. Run again with the same frames it gives the same numbers. Null users have none."""
    users = hits.select(F.col(user).alias("user")).where("user is not null").distinct()
    place = F.pmod(F.xxhash64("user"), F.lit(PLACES))
    if known is not None:
        users = users.join(known.select("user"), "user", "left_anti")
    users = users.withColumn("place", place)
    numbered = users.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy("user")).cast("bigint"))
    taken = F.lit(0).cast("bigint")
    if known is not None:
        used = known.groupBy(F.pmod("code", F.lit(PLACES)).alias("place")).agg((F.max("code") / PLACES).cast("bigint").alias("used"))
        numbered, taken = numbered.join(used, "place", "left"), F.coalesce(F.col("used") + 1, taken)
    return numbered.select("user", ((F.col("rank") - 1 + taken) * PLACES + F.col("place")).alias("code"))


def daily_users(hits: DataFrame, codes: DataFrame, dimensions: Sequence[str | Column] = (), user: str = "user_id", ts: str = "ts") -> DataFrame:
    """day, the dimensions, bucket, users (a bitmap), hits: what is stored of a day. Hits of users without a number count as hits only,
    in a row with a null bucket."""
    keys = [F.to_date(ts).alias("day"), *dimensions]
    # One row a user, day and dimension is all that the numbers are looked up for.
    summed = hits.groupBy(*keys, F.col(user).alias("user")).agg(F.count(F.lit(1)).alias("hits"))
    names = summed.columns[: len(keys)]
    coded = summed.join(codes, "user", "left")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("code"))
    rows = coded.groupBy(*names, F.bitmap_bucket_number("code").alias("bucket")).agg(bits.alias("users"), F.sum("hits").alias("hits"))
    return rows.withColumn("users", F.when(F.col("bucket").isNotNull(), F.col("users")))


def users_over(rollup: DataFrame, period: Column | None = None, dimensions: Sequence[str] = ()) -> DataFrame:
    """period (if one is given: an expression of `day`), the dimensions, users, hits: exact distinct users of the rollup's rows."""
    keys = ([period.alias("period")] if period is not None else []) + [F.col(d) for d in dimensions]
    merged = rollup.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"), F.sum("hits").alias("hits"))
    names = merged.columns[: len(keys)]
    counted = F.when(F.col("bucket").isNull(), 0).otherwise(F.bitmap_count("users"))
    return merged.groupBy(*names).agg(F.sum(counted).alias("users"), F.sum("hits").alias("hits"))

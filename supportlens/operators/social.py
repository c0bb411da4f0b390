"""Tweets and the posts they answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supportlens.functions.text import escape_newlines
from supportlens.functions.time import seconds_between
from supportlens.operators.skew import first_by

PARENT = "in_reply_to_status_id_str"


def tweet_rows(tweets: DataFrame) -> DataFrame:
    """Tweet objects to the mentions table's columns."""
    return tweets.select(
        F.col("id_str").cast("long").alias("id_str"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        escape_newlines("full_text").alias("full_text"),
        F.col("user.id").cast("long").alias("user_id"),
        F.col(PARENT).cast("long").alias(PARENT),
    )


def enrich_replies(mentions: DataFrame, posts: DataFrame) -> DataFrame:
    """Each tweet once, with text, time and author of the post it answers, nulls where there is none.

    A post stored several times counts once, in its earliest version. Tweets that answer nothing have keys of their own in
    the join, which no post has, so that no task gets all of them.
    """
    once = first_by(posts.where("id_str is not null"), ["id_str"], [F.col("created_at").asc_nulls_last(), F.col("user_id").asc()])
    parents = once.select(
        F.col("id_str").cast("string").alias("_key"),
        F.col("full_text").alias("in_reply_to_status_text"),
        F.col("created_at").alias("in_reply_to_status_created_at"),
        F.col("user_id").alias("in_reply_to_status_user_id"),
    )
    alone = F.concat(F.lit("none "), F.pmod(F.xxhash64("id_str"), F.lit(100_000)).cast("string"))
    keyed = mentions.withColumn("_key", F.coalesce(F.col(PARENT).cast("string"), alone))
    return keyed.join(parents, "_key", "left").select(*mentions.columns, *[c for c in parents.columns if c != "_key"])


def reply_first_response(reviews: DataFrame) -> DataFrame:
    """The fastest replies to each post, ties kept; rows without a parent or a time drop out.

    Each task keeps the fastest of its own before the shuffle, so a post with very many replies costs no more than others.
    """
    timed = reviews.withColumn("response_time", seconds_between("in_reply_to_status_created_at", "created_at"))
    known = timed.where(F.col(PARENT).isNotNull() & F.col("response_time").isNotNull())
    rank = F.rank().over(Window.partitionBy(PARENT).orderBy("response_time"))
    return known.withColumn("_rank", rank).where("_rank = 1").drop("_rank")

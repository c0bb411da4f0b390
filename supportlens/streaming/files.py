"""Structured Streaming over folders of exports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from supportlens.functions.text import lower_token, tokens

def file_stream(spark: SparkSession, path: str, schema: T.StructType, archive: str | None = None) -> DataFrame:
    """New JSON files of a folder; read ones move to the archive folder."""
    reader = spark.readStream.schema(schema)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)


def load_available(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Everything not loaded yet, transformed and appended to parquet exactly once; then stops."""
    return (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_terms(stream: DataFrame, ts: str, text: str, settling: str, ignore: Sequence[str] = ()) -> DataFrame:
    """Term counts a day, final once the settling time has passed: rows that come later than that after the newest day
    are not in them. `too_late` gives those rows for a side table."""
    days = stream.withColumn("_day", F.date_trunc("day", F.col(ts).cast("timestamp"))).withWatermark("_day", settling)
    terms = days.select("_day", F.explode(tokens(text)).alias("token"))
    words = terms.select("_day", lower_token("token").alias("tweet_word"))
    kept = words.where(~F.col("tweet_word").isin(list(ignore))) if ignore else words
    counts = kept.groupBy("_day", "tweet_word").agg(F.count("*").alias("tweet_freq"))
    return counts.select(F.col("_day").cast("date").alias("tweet_dt"), "tweet_word", "tweet_freq")


def too_late(batch: DataFrame, counted: DataFrame, ts: str, day: str = "tweet_dt") -> DataFrame:
    """Rows of a batch whose day is counted already and so takes no more of them, for a side table and a recount."""
    days = counted.select(F.col(day).alias("_day")).distinct()
    return batch.withColumn("_day", F.to_date(ts)).join(days, "_day", "left_semi").drop("_day")

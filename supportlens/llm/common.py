"""Shared helpers: the shared scratch folder, tables that cut lineage, and words as the operators count them."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of the word and equality rules (fixed values).
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Frames of at most so many narrow rows (a few hundred bytes each) may be broadcast; larger ones join by shuffle.
BROADCAST_ROWS = 20_000

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's `spark.checkpoint.dir`. Only a local session without that setting
    gets a temporary folder of its own; on a cluster the setting is required."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="llm-")
        _local[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


def let_workers_import(spark: SparkSession) -> None:
    """Puts this package's place on the Python workers' path, for sessions started elsewhere. Executors of a cluster need the
    package at that place too, or by --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; Spark's file system removes it when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: later steps neither repeat its work nor lose it with an
    executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """`df` with a broadcast hint if its counted rows are within BROADCAST_ROWS."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_draw(*parts: Column) -> Column:
    """A number in [0, 1) that hangs on the parts alone, the same in every run and engine."""
    digest = F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def semi(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id (null included) and text have a row (_id, _hash) in `kept`; fully repeated pairs
    once. The texts move once, since rank and join share a partitioning, and each task drops its repeated pairs before it
    sends them."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    rows = rows.withColumns({"_null": F.col("_id").isNull(), "_id": F.coalesce("_id", F.lit(0))})
    kept = kept.withColumns({"_null": F.col("_id").isNull(), "_id": F.coalesce("_id", F.lit(0))})
    key = ["_id", "_null", "_hash"]
    first = Window.partitionBy(*key).orderBy(F.lit(1))
    once = rows.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1")
    return once.join(kept, key, "left_semi").select("_row.*")

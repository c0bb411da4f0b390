"""Sharding by fixed virtual slots: rows are hashed into thousands of slots, and a stored, versioned map gives each slot its
shard. Rebalancing edits the map; rows never change their slot.

Only DataFrame functions. The law is `bytes`: shards near equal in size. Only slot sums, one row a slot, meet in one
place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supportlens.llm.common import new_path, stored

SLOTS = 4096
SHARDS = 8


def virtual_slot(slots: int) -> Column:
    """The slot of (doc_id, text_crc32): the text's checksum spreads rows that repeat a doc_id."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text_crc32")]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12), 16, 10).cast("long") % slots


def slot_rows(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every row, written once."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )
    return stored(rows.withColumn("vslot", virtual_slot(slots)), "slot-rows")


def slot_sums(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows of every slot, empty ones too: `slots` rows."""
    sums = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    every = rows.sparkSession.range(slots).withColumnRenamed("id", "vslot")
    return every.join(sums, "vslot", "left").na.fill(0, ["bytes", "rows"])


def first_map(spark: SparkSession, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Version 0: the slots dealt out in turn."""
    return spark.range(slots).select(F.col("id").alias("vslot"), (F.col("id") % shards).cast("int").alias("shard"))


def store_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Adds a version of the map to the table at `path`; earlier versions stay as they are."""
    slot_map.select("vslot", "shard").coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("vslot bigint, shard int").parquet(f"{path}/version={version}")


def rebalanced(slot_map: DataFrame, sums: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The map edited for near equal bytes, moving as few bytes as the shards' surplus asks for.

    Each shard below `shards` keeps its slots, largest first, up to the mean size of a shard; the rest (and all slots of
    shards taken out of service) go one by one, largest first, to the shard that is lightest by then. The loop folds an array of
    at most one entry a slot, a number fixed in advance.
    """
    held = slot_map.join(sums, "vslot").withColumn("mean", F.sum("bytes").over(Window.partitionBy()) / F.lit(float(shards)))
    by_size = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    held = held.withColumn("upto", F.sum("bytes").over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    held = held.withColumn("stays", (F.col("shard") < shards) & (F.col("upto") <= F.col("mean")))
    loads = [F.sum(F.when(F.col("stays") & (F.col("shard") == s), F.col("bytes")).otherwise(0)) for s in range(shards)]
    moving = F.sort_array(F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("minus"), F.col("vslot").alias("vslot")))))
    start = F.struct(F.array(*(F.coalesce(x, F.lit(0)).cast("bigint") for x in loads)).alias("loads"),
                     F.array().cast("array<struct<vslot:bigint,shard:int>>").alias("moves"))
    folded = held.agg(moving.alias("moving"), start.alias("start")).select(F.expr("""
        aggregate(moving, start, (held, m) -> struct(
            transform(held.loads, (x, i) -> x - IF(i + 1 = array_position(held.loads, array_min(held.loads)), m.minus, 0L)) AS loads,
            concat(held.moves, array(struct(m.vslot AS vslot,
                CAST(array_position(held.loads, array_min(held.loads)) - 1 AS INT) AS shard))) AS moves))""").alias("end"))
    moves = folded.select(F.inline("end.moves"))
    return held.filter("stays").select("vslot", "shard").unionByName(moves)


def placed(rows: DataFrame, slot_map: DataFrame, sums: DataFrame) -> DataFrame:
    """`rows` with shard and slot, the row's gapless place in its shard: places of the virtual slots before it in the shard, from the
    slot sums, plus its rank in its own slot. No shard meets in one task."""
    order = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(sums, "vslot").select(
        "vslot", "shard", F.coalesce(F.sum("rows").over(order), F.lit(0)).cast("long").alias("start")
    )
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    ranked = rows.withColumn("rank", rank)
    return ranked.join(F.broadcast(starts), "vslot").withColumn("slot", F.col("start") + F.col("rank") - 1)


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot.

    Null texts have size 1 and checksum 0; null ids and repeated rows are placed like others (rows equal in doc_id and text share
    a virtual slot, the grain of balance); an empty table gives no rows; other columns are ignored. The broadcast map has `slots` rows.
    """
    spark = docs.sparkSession
    rows = slot_rows(docs, slots)
    sums = stored(slot_sums(rows, slots), "slot-sums")
    path = new_path(spark, "slot-map")
    store_map(first_map(spark, slots, shards), path, 0)
    store_map(rebalanced(load_map(spark, path, 0), sums, shards), path, 1)
    out = placed(rows, load_map(spark, path, 1), sums)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "vslot")

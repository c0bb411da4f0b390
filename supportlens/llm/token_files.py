"""Token ids in Parquet: a list column with dictionary or delta encoding, bounded row groups, small pages and page indexes.

Files follow each other in ascending doc_id order. Beside the ids each row holds its token count and its place in its part, so
that counts and offsets are read without the ids, and rows of a few documents by their pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supportlens.llm import tokens
from supportlens.llm.common import new_path, small_side

END_ID = 1
ROW_GROUP = 32 << 20
PAGE = 256 << 10
PAGE_ROWS = 1000


def encoded(docs: DataFrame, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, part, part_start, ids in ascending doc_id order, null ids first. Rows of one doc_id are ordered and spread by
    their text's hash."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = text.schema["doc_id"].dataType.simpleString()
    order = ["doc_id", "hash"]
    text = text.withColumn("hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    text = text.select("doc_id", "text", F.spark_partition_id().alias("part"))
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = tokens.encoder(tokens.WordEncoder, vocabulary), 0
        for batch in batches:
            data = [ids + end for ids in encoder.encoded(value.as_py() or "" for value in batch.column(1))]
            counts = np.fromiter(map(len, data), np.int64, len(data)) // 4
            ends = np.cumsum(counts)
            ids = np.frombuffer(b"".join(data), "<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
            columns = [batch.column(0), pa.array(counts), batch.column(2), pa.array(start + ends - counts), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "part", "part_start", "ids"])
            start += int(ends[-1]) if len(ends) else 0

    return text.mapInArrow(encode, f"doc_id {kind}, n_tokens bigint, part int, part_start bigint, ids array<int>")


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str | None = None, encoding: str = "dictionary", row_group: int = ROW_GROUP, page: int = PAGE
) -> None:
    """Writes the documents' ids to `path`. encoding: `dictionary`, or `delta` (binary packed differences)."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is dictionary or delta")
    rows = encoded(docs, vocabulary or tokens.vocabulary("word_bpe_49k.json"))
    options = {
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.writer.version": "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0",
        "parquet.block.size": str(row_group), "parquet.page.size": str(page), "parquet.page.row.count.limit": str(PAGE_ROWS),
        "compression": "zstd",
    }
    rows.write.options(**options).parquet(path)


def read_token_files(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """The rows of the files; with bounds, only the row groups and pages that can hold such ids are read."""
    rows = spark.read.parquet(path)
    if first_id is not None:
        rows = rows.filter(F.col("doc_id") >= first_id)
    if last_id is not None:
        rows = rows.filter(F.col("doc_id") <= last_id)
    return rows


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """part and the number of ids before it, one row a file; reads no ids."""
    sums = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first"))


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start (ids of all rows before it), n_tokens, ids_crc32."""
    starts = part_starts(spark, path)
    rows = read_token_files(spark, path).join(small_side(starts, starts.count()), "part")
    rows = rows.select("doc_id", (F.col("first") + F.col("part_start")).alias("start"), "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            at = lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(sums, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_round_trip(docs: DataFrame, **options) -> DataFrame:
    """Writes the documents to new files in the shared folder and reads them back: the rows of `token_rows`.

    Null and empty texts are their end token alone; repeated rows each have theirs. An empty table gives no rows. Other
    columns are ignored.
    """
    path = new_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, **options)
    return token_rows(docs.sparkSession, path)

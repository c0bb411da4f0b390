"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Only DataFrame functions. A first scan counts rows by length and prefix hash of the normalised text. Texts whose length and
prefix hash nobody shares are done; the second scan hashes the full content of the others alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.llm.common import SPACES, semi, stored

PREFIX_CHARS = 64
#: Bits of the broadcast filter of surviving groups: 8 MB whatever the input. A filter that fills up lets more rows
#: through to the full hash and changes no result.
FILTER_BITS = 1 << 26


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def _bit() -> Column:
    return F.pmod(F.xxhash64("norm_len", "prefix_hash"), F.lit(FILTER_BITS))


def _surviving(shapes: DataFrame) -> DataFrame:
    """Bitmap of the lengths and prefix hashes that two rows and more share: at most FILTER_BITS / 32768 rows of 4 kB."""
    groups = shapes.groupBy("norm_len", "prefix_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bits = groups.select(_bit().alias("bit"))
    return bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap")
    )


def _is_set() -> Column:
    """Whether the row's bit is set in the bitmap joined to it; bits count from the lowest of each byte."""
    byte = F.conv(F.hex(F.expr("substring(bitmap, CAST(place DIV 8 AS INT) + 1, 1)")), 16, 10).cast("long")
    return F.coalesce(F.getbit(byte, (F.col("place") % 8).cast("int")), F.lit(0)) == 1


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_hash, and text_sha256 if `digest`.

    Texts are equal if they are the same without white space; null counts as empty. Of equal texts, the one with the most
    code points and then the smallest doc_id (null ids last) is kept; of repeated rows, exactly one. Without `digest`, texts
    outside shared lengths and prefixes are never hashed in full; with it their hash is made for the report alone. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shaped = text.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("chars"), normalised(F.col("text")).alias("norm"), F.xxhash64("text").alias("text_hash"))
    shaped = shaped.withColumns({
        "norm_len": F.length("norm"), "prefix_hash": F.xxhash64(F.substring("norm", 1, prefix_chars)),
    })
    filter_ = F.broadcast(_surviving(shaped.select("norm_len", "prefix_hash")))
    tested = shaped.withColumns({"at": F.bitmap_bucket_number(_bit()), "place": F.bitmap_bit_position(_bit())})
    tested = tested.join(filter_, F.col("at") == F.col("bucket"), "left")
    digest_cols = {"text_sha256": F.sha2("norm", 256)} if digest else {}
    hashed = tested.withColumns({"full_hash": F.when(_is_set(), F.sha2("norm", 256)).otherwise(""), **digest_cols})
    rows = stored(
        hashed.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "chars", "norm_len", "prefix_hash", "full_hash", "text_hash", *digest_cols
        ),
        "exact-rows",
    )  # the row numbers are fixed from here on
    key = ["norm_len", "prefix_hash", "full_hash"]
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row")))
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    joined = rows.join(groups.select(*key, "group_size", "best.keep_id", "best.keep_row"), key)
    return joined.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_hash", *digest_cols)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Repeated rows of one doc_id and text are kept once."""
    kept = exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    return semi(docs, kept)

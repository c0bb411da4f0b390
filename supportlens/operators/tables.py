"""Comparing and measuring whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def difference(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that one table holds more often than the other: `extra` counts them, negative for the right's.

    One signed count over both tables, so one shuffle of counted rows answers both directions.
    """
    both = left.select(*columns, F.lit(1).alias("_sign")).unionAll(right.select(*columns, F.lit(-1).alias("_sign")))
    return both.groupBy(*columns).agg(F.sum("_sign").alias("extra")).where("extra <> 0")


def differs(left: DataFrame, right: DataFrame) -> bool:
    if left.columns != right.columns:
        return True
    return not difference(left, right, left.columns).isEmpty()


#: Column types whose values are written alike in every session.
_PLAIN = ("string", "bigint", "int", "smallint", "tinyint", "boolean", "date", "timestamp_ntz", "binary")


def row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row as one text that differs wherever the rows do: each value with its length before it, null as a sign of its own."""
    kinds = dict(df.dtypes)
    value = lambda c: F.col(c).cast("string") if kinds[c] in _PLAIN else F.to_json(F.struct(c))
    told = lambda v: F.coalesce(F.concat(F.char_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.concat(*[told(value(c)) for c in columns])


def fingerprints(df: DataFrame, columns: Sequence[str], by: Sequence[Column | str] = ()) -> DataFrame:
    """`by`, n, total, mixed: a fingerprint of each part's rows whatever their order, repeats counted. Two halves of a row's checksum are summed (as
    text, since the sum may pass a long) and xor-ed, so that one aggregate is enough and no row is shuffled."""
    digest = F.md5(row_text(df, columns).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")
    rows = df.select(*by, half(1).alias("_a"), half(17).alias("_b"))
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.col("_a").cast("decimal(28,0)")).cast("string").alias("total"), F.bit_xor("_b").alias("mixed")]
    return rows.groupBy(*rows.columns[:-2]).agg(*sums)


def changed_parts(old: DataFrame, new: DataFrame) -> DataFrame:
    """The parts (first columns of two `fingerprints`) that differ, and in `kept` whether the new side has them."""
    parts = [c for c in new.columns if c not in ("n", "total", "mixed")]
    sides = [side.select(*parts, F.struct("n", "total", "mixed").alias(name)) for side, name in ((old, "_old"), (new, "_new"))]
    both = sides[0].withColumn("_new", F.lit(None).cast(dict(sides[1].dtypes)["_new"])).unionByName(sides[1].withColumn("_old", F.lit(None).cast(dict(sides[0].dtypes)["_old"])))
    met = both.groupBy(*parts).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    return met.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(*parts, F.col("_new").isNotNull().alias("kept"))


def reload_changed(df: DataFrame, path: str, key: str, buckets: int = 256) -> list[int]:
    """Brings the table at `path` to the rows of `df` and tells which buckets of `key` it rewrote; the others are read for their stored
    fingerprints only. Fingerprints are written last: after a failure in between, the same buckets are written again."""
    spark = df.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/fingerprints")
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    new = fingerprints(df, df.columns, [bucket])
    old = spark.read.schema(new.schema).parquet(f"{path}/fingerprints") if there else new.limit(0)
    now = spark.createDataFrame(new.collect(), new.schema)  # at most `buckets` rows
    changed = {r["_bucket"]: r["kept"] for r in changed_parts(old, now).collect()}
    if not changed:
        return []
    rows = df.withColumn("_bucket", bucket).where(F.col("_bucket").isin(sorted(changed)))
    empty = [b for b, kept in changed.items() if not kept]
    written = rows.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    written.partitionBy("_bucket").parquet(f"{path}/rows")
    for b in empty:
        gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/rows/_bucket={b}")
        gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    now.coalesce(1).write.mode("overwrite").parquet(f"{path}/fingerprints")
    return sorted(changed)

"""The latest version of each key, kept up to date: batches of versions are merged into a stored table by hash buckets.

A batch rewrites only the buckets that its keys fall into. Which version wins hangs on the versions alone, so that batches in any order,
late ones and repeated ones end in the same table as all versions at once; a run that failed in the middle is simply run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from supportlens.operators.skew import first_by
from supportlens.sources.sinks import staging

BUCKETS = 256


def _order(df: DataFrame, updated: str) -> list[Column]:
    """Later versions first, undated ones last; of equally late ones the content decides."""
    return [F.col(updated).desc_nulls_last(), F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256).desc()]


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def merge_versions(batch: DataFrame, path: str, key: str, updated: str = "updated", buckets: int = BUCKETS) -> list[int]:
    """Merges a batch of versions into the table at `path` and tells which buckets it rewrote. Columns are those of the first batch. Rows
    without a key are one key like any other. The merged buckets are staged in full before they replace the old ones."""
    spark = batch.sparkSession
    rows = first_by(batch, [key], _order(batch, updated)).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    new = staging(spark, "versions")
    rows.write.parquet(f"{new}/batch")
    rows = spark.read.schema(rows.schema).parquet(f"{new}/batch")
    touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())  # at most `buckets` numbers
    if not touched:
        return []
    if _exists(spark, path):
        kept = spark.read.schema(rows.schema).parquet(path).where(F.col("_bucket").isin(touched))
        names = [c for c in rows.columns if c != "_bucket"]
        merged = first_by(kept.unionByName(rows), [key], _order(rows.select(*names), updated))
        merged.write.parquet(f"{new}/merged")
        rows = spark.read.schema(rows.schema).parquet(f"{new}/merged")
    written = rows.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    written.partitionBy("_bucket").parquet(path)
    return touched


def latest_versions(spark: SparkSession, path: str) -> DataFrame:
    """The table as it stands, one row a key."""
    return spark.read.parquet(path).drop("_bucket")


def keep_latest(stream: DataFrame, path: str, key: str, checkpoint: str, updated: str = "updated", buckets: int = BUCKETS) -> StreamingQuery:
    """Merges all that a stream of versions has not given yet; then stops. A batch that is given again changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        merge_versions(batch, path, key, updated, buckets)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_all(batches: Sequence[DataFrame], path: str, key: str, updated: str = "updated", buckets: int = BUCKETS) -> DataFrame:
    """The table after several batches."""
    for batch in batches:
        merge_versions(batch, path, key, updated, buckets)
    return latest_versions(batches[0].sparkSession, path)

"""Writers: append, overwrite, month replacement, staged files, table bootstrap."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supportlens.operators.incremental import new_rows, read_watermark
from supportlens.operators.tables import differs
from supportlens.schemas import STORED_BY_DAY, TABLES


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame's columns in table order and type; a missing or a spare column is an error."""
    if set(df.columns) != set(schema.names):
        raise ValueError(f"columns {sorted(df.columns)} do not fit {sorted(schema.names)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _by_day(df: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
    """The frame with its day column, and that column's name in a list; as it is where the table has none."""
    if table not in STORED_BY_DAY:
        return df, []
    day = f"{STORED_BY_DAY[table]}_day"
    return df.withColumn(day, F.to_date(STORED_BY_DAY[table])), [day]


def ensure_table(spark: SparkSession, name: str, table: str) -> DataFrame:
    """The stored table `name`, created empty by the catalogue's schema of `table` where it is missing."""
    if not spark.catalog.tableExists(name):
        empty, days = _by_day(spark.createDataFrame([], TABLES[table]), table)
        empty.write.saveAsTable(name, format="parquet", partitionBy=days or None)
    return spark.table(name)


def stored_watermark(spark: SparkSession, name: str, column: str, default: Any = None) -> Any:
    """The greatest stored value of a column; of a table stored by its days only the last day is read."""
    stored, day = spark.table(name), f"{column}_day"
    if day in stored.columns:
        dated = spark.sql(f"SHOW PARTITIONS {name}").where("partition not like '%__HIVE_DEFAULT_PARTITION__%'")
        last = dated.agg(F.max(F.split("partition", "=")[1])).first()[0]
        if last is not None:
            found = read_watermark(stored.where(F.col(day) == F.lit(last).cast("date")), column)
            if found is not None:
                return found
    return read_watermark(stored, column, default)


def plain(df: DataFrame) -> DataFrame:
    """A stored table without the column it is stored by."""
    return df.drop(*{f"{column}_day" for column in STORED_BY_DAY.values()})


def ensure_all(spark: SparkSession, database: str) -> list[str]:
    """Every table of the catalogue, in one database."""
    for table in TABLES:
        ensure_table(spark, f"{database}.{table}", table)
    return list(TABLES)


def append(df: DataFrame, name: str, table: str) -> None:
    """Rows to a stored table. Those of one day are brought together first, in files of fit size however they spread."""
    rows, days = _by_day(to_schema(df, TABLES[table]), table)
    (rows.hint("rebalance", *days) if days else rows).write.insertInto(name)


def append_new(df: DataFrame, name: str, table: str, keys: Sequence[str]) -> None:
    """Append of rows whose keys are not there yet; a second run adds nothing. Of a table stored by day, only the batch's
    days are compared: a row that comes again comes with its time. The batch, parsing included, is made once and staged, since its
    days have to be known before it is compared."""
    loaded, days = df.sparkSession.table(name), _by_day(df, table)[1]
    if days:
        df = staged(df, "batch")
        low, high = df.agg(F.min(STORED_BY_DAY[table]).cast("date"), F.max(STORED_BY_DAY[table]).cast("date")).first()
        day = F.col(days[0])
        loaded = loaded.where(day.isNull() | day.between(F.lit(low), F.lit(high)))
    append(new_rows(df, loaded, keys), name, table)


def staging(spark: SparkSession, name: str) -> str:
    """A fresh folder for staged files in the shared `spark.checkpoint.dir`; a local session without it has its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="staged-")
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the staging folder and read back, for steps that would make it more than once."""
    path = staging(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite(df: DataFrame, name: str, table: str) -> None:
    rows, _ = _by_day(to_schema(df, TABLES[table]), table)
    rows.write.option("partitionOverwriteMode", "static").insertInto(name, overwrite=True)


def sync_rules(spark: SparkSession, rules: DataFrame, name: str) -> bool:
    """Stores the rules where the table is missing or differs; tells whether it wrote."""
    stored = ensure_table(spark, name, "keywords_map")
    changed = differs(rules, stored)
    if changed:
        overwrite(rules, name, "keywords_map")
    return changed


def write_months(df: DataFrame, path: str, ts: str) -> None:
    """Replaces the months the frame holds, and only those, in a table parted by month. A row without a time belongs to
    no month and is an error: it would replace such rows of earlier loads."""
    dated = F.coalesce(F.date_format(F.col(ts), "yyyy-MM"), F.raise_error(F.lit(f"a row without {ts}")))
    month = dated.alias("month")
    df.select("*", month).hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "month"
    ).parquet(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    """Staged lines of JSON: null fields left out, ISO times."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", quote_all: bool = False, encoding: str = "UTF-8") -> None:
    """Staged CSV with header; quotes double, line ends stay inside quotes."""
    df.write.mode("overwrite").csv(path, sep=sep, header=True, quoteAll=quote_all, escape='"', encoding=encoding)


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame and an observation that holds its row count once an action ran; no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("loaded")), seen

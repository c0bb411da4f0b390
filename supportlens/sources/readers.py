"""Readers. Schemas are always given, so no pass over the data is spent on guessing them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supportlens.operators.mirror import Cut, conform, range_predicates
from supportlens.schemas import MIRROR, mirror_kinds

QUESTION_PAGE = (
    "count bigint, results array<struct<id: bigint, content: string, created: string, "
    "creator: struct<username: string>, updated: string, updated_by: string, is_solved: boolean, locale: string, "
    "product: string, title: string, topic: string, solution: bigint, solved_by: string, num_votes: bigint, "
    "num_votes_past_week: bigint, last_answer: bigint, metadata: string, tags: string, answers: string>>"
)
ANSWER_PAGE = (
    "count bigint, results array<struct<id: bigint, question: bigint, content: string, created: string, "
    "creator: struct<username: string>, updated: string, updated_by: string, is_spam: boolean, "
    "num_helpful_votes: bigint, num_unhelpful_votes: bigint>>"
)
SURVEY_PAGE = (
    "total_count bigint, total_pages bigint, data array<struct<id: string, date_started: string, "
    "date_submitted: string, status: string, contact_id: string, language: string, referer: string, "
    "session_id: string, user_agent: string, longitude: string, latitude: string, country: string, city: string, "
    "region: string, postal: string, survey_data: map<string, struct<answer: string>>>>"
)
REPORT = (
    "reports array<struct<data: struct<rows: array<struct<dimensions: array<string>, "
    "metrics: array<struct<values: array<string>>>>>>>>"
)
TWEET = (
    "id_str string, created_at string, full_text string, user struct<id: bigint>, in_reply_to_status_id_str string"
)


def read_table(spark: SparkSession, path: str, spread_by: str | None = None) -> DataFrame:
    """A parquet table. With spread_by its rows are dealt out anew by that column, for files of one row group, which can't
    be split: worth it before parsing or matching texts. Tables of many row groups need none."""
    table = spark.read.parquet(path)
    return table if spread_by is None else table.repartition(F.col(spread_by))


def parse_pages(pages: DataFrame, schema: str, records: str, json: str = "value") -> DataFrame:
    """Saved API pages, one JSON text a row, to one row a record. Every page counts, the last one too."""
    return pages.select(F.explode(F.from_json(json, schema)[records]).alias("r")).select("r.*")


def read_pages(spark: SparkSession, path: str, schema: str, records: str) -> DataFrame:
    """The same from a folder with one page a line."""
    return parse_pages(spark.read.text(path), schema, records)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Saved analytics responses, one a line, to one row a report."""
    return read_pages(spark, path, REPORT, "reports")


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TWEET).json(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Typed CSV with the rows that do not fit in `_corrupt`, for check_bad_rows to judge."""
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    return spark.read.schema(with_corrupt).csv(
        path,
        sep=sep,
        header=header,
        encoding=encoding,
        multiLine=multi_line,
        quote='"',
        escape='"',
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="_corrupt",
    )


def split_bad_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the bad ones with what could be read of them and their raw lines in `_corrupt`."""
    return rows.where("_corrupt is null").drop("_corrupt"), rows.where("_corrupt is not null")


def check_bad_rows(rows: DataFrame, allowed: int, aside: str | None = None) -> DataFrame:
    """The good rows; an error once more than `allowed` rows are bad. Where some are allowed they are appended to the
    folder `aside` first, and counted by that write. With none allowed the good rows raise as they are read, in no
    further pass."""
    good, bad = split_bad_rows(rows)
    if not allowed:
        stop = F.raise_error(F.concat(F.lit("more than 0 bad rows: "), F.col("_corrupt")))
        return rows.where(F.col("_corrupt").isNull() | stop.cast("boolean")).drop("_corrupt")
    if aside is None:
        raise ValueError("bad rows that are allowed need a folder to be stored in")
    seen = Observation("bad rows")
    bad.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").json(aside)
    if seen.get["n"] > allowed:
        raise ValueError(f"more than {allowed} bad rows, stored in {aside}")
    return good


def read_store_reviews(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Review exports come in UTF-16; quoted texts may hold line ends. Such files can't be split: each is one task, so large
    exports should come as many files (the source gives one a month)."""
    return check_bad_rows(read_csv(spark, path, schema, encoding="UTF-16", multi_line=True), 0)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """URL and word lists: one entry a line in `value`, trailing blanks cut, empty lines left out."""
    return spark.read.text(path).select(F.rtrim("value").alias("value")).where("value <> ''")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated topic rules (topic, keywords) with a header."""
    return spark.read.schema("topic string, keywords string").csv(path, sep="\t", header=True)


def rule_list(rules: DataFrame, most: int = 10_000) -> list[tuple[str, str]]:
    """Rules as the literal list the topic expression is built of. They are configuration, so their number is checked."""
    rows = rules.select("topic", "keywords").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules")
    return [(r["topic"], r["keywords"]) for r in rows]


def word_list(words: DataFrame, most: int = 100_000) -> list[str]:
    """A stop-word or term list as a literal list, its size checked."""
    rows = words.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} words")
    return [r[0] for r in rows]


def mirror_query(table: str, source_names: Mapping[str, str] | None = None) -> str:
    """The projection that reads a source table; source_names for columns that the source calls otherwise."""
    known = source_names or {}
    return ", ".join(known.get(name, name) for name, _ in mirror_kinds(MIRROR[table]))


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    compat: bool = False,
    source_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """A source table as its typed mirror, read by `partitions` ranges of its key between the bounds, so that no one task
    reads it whole; keys outside the bounds are in the outer ranges."""
    source = f"(select {mirror_query(table, source_names)} from {table}) as t"
    rows = spark.read.jdbc(url, source, key, bounds[0], bounds[1], partitions, properties=properties)
    return conform(rows, table, compat)


def read_votes(spark: SparkSession, url: str, properties: dict[str, str], cuts: Sequence[Cut]) -> DataFrame:
    """The vote table by ranges of its creation day. The last cut should be near today: what is after it is one range.
    `mirror.balanced_cuts` of the votes stored before gives cuts of near equal ranges."""
    predicates = range_predicates("created", cuts)
    return conform(spark.read.jdbc(url, "wiki_helpfulvote", predicates=predicates, properties=properties), "wiki_helpfulvote")

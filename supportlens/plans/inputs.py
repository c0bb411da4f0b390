"""The support tables the queries read, derived in full from the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supportlens.sources.readers import read_table


def load(spark: SparkSession, folder: str, name: str, spread_by: str | None = None) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", spread_by)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents", spread_by="doc_id")


def at(seconds: Column | str) -> Column:
    """2024-01-01 plus seconds."""
    seconds = F.expr(seconds) if isinstance(seconds, str) else seconds
    return F.expr("timestamp_ntz'2024-01-01 00:00:00'") + seconds * F.expr("interval '1' second")


def tweets(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    docs = documents(spark, folder) if spread else load(spark, folder, "documents")
    return docs.select(
        F.col("doc_id").alias("id_str"),
        at("(doc_id % 30) * 86400 + doc_id % 80000").alias("created_at"),
        F.col("text").alias("full_text"),
        (F.col("doc_id") % 97).alias("user_id"),
        F.expr("case when doc_id % 5 <> 0 then doc_id div 3 end").alias("in_reply_to_status_id_str"),
    )


def question_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw question rows: every turn of a user, in three versions, the first of them undated. Turns of the system are no
    posts of a forum."""
    asked = load(spark, folder, "conversations").where("role = 'user'")
    created = at("conv_id * 3607 + turn * 60")
    versions = asked.withColumn("v", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    return versions.select(
        F.expr("conv_id * 1000 + turn").alias("question_id"),
        F.concat("text", F.lit(" v"), F.col("v").cast("string")).alias("question_content"),
        created.alias("created_date"),
        F.when(F.col("v") > 0, created + F.col("v") * F.expr("interval '1' hour")).alias("updated"),
        F.concat(F.lit("About the "), "role", F.lit(" in "), F.col("conv_id").cast("string")).alias("title"),
        F.expr("case conv_id % 3 when 0 then 'os Linux' when 1 then 'OS X' else '' end").alias("metadata_array"),
    )


def answer_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw answer rows: every turn of an assistant, to the last question before it in its conversation, if there is one."""
    created = at("conv_id * 3607 + turn * 60 + (conv_id * 7919 + turn * 104729) % 200000")
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    asked = F.max(F.expr("case when role = 'user' then conv_id * 1000 + turn end")).over(before)
    answers = load(spark, folder, "conversations").withColumn("question_id", asked).where("role = 'assistant'")
    versions = answers.withColumn("v", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    return versions.select(
        F.expr("conv_id * 1000 + turn").alias("answer_id"),
        "question_id",
        F.concat("text", F.lit(" v"), F.col("v").cast("string")).alias("answer_content"),
        created.alias("created_date"),
        F.when(F.col("v") > 0, created + F.col("v") * F.expr("interval '1' hour")).alias("updated"),
    )


def hits(spark: SparkSession, folder: str, countries: bool = False) -> DataFrame:
    """Web hits: the events, with a page by type and key, a session a user and day, and if asked for the user's nation."""
    rows = load(spark, folder, "events").select(
        F.col("event_id").alias("hit_id"),
        "ts",
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("#"), F.to_date("ts").cast("string")).alias("session_id"),
        F.expr(
            "case event_type when 'view' then '/en-US/kb/topic-' when 'click' then '/en-US/questions/' "
            "when 'signup' then '/en-US/kb/topic-' when 'error' then '/de/kb/Topic-' else '/en-US/products/' end "
            "|| get_json_object(props, '$.k') || case event_type when 'signup' then '?from=mail' else '' end"
        ).alias("page_path"),
        F.expr("case event_type when 'signup' then 'InProduct' else 'web' end").alias("source"),
        F.expr("case event_type when 'purchase' then 'organic' else 'none' end").alias("medium"),
        F.expr(
            "case event_type when 'click' then 'Result Clicked' when 'view' then 'Search' else '' end"
        ).alias("event_action"),
    )
    if not countries:
        return rows
    nation = load(spark, folder, "nation").select(F.col("n_nationkey"), F.col("n_name").alias("country"))
    return rows.join(nation, F.col("user_id") % 25 == F.col("n_nationkey"), "left").drop("n_nationkey")


def listed_urls(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "nation").select(
        F.concat(F.lit(SITE), F.lit("/en-US/kb/topic-"), F.col("n_nationkey").cast("string")).alias("value")
    )


SITE = "https://help.example.org"

_START = "1704067200"
_VERSIONS = "CROSS JOIN (VALUES (0), (1), (2)) AS versions(v)"


def _at(seconds: str) -> str:
    return f"make_timestamp(({_START} + {seconds}) * 1000000)"


_QUESTION_TIME = "conv_id * 3607 + turn * 60"
_ANSWER_TIME = "conv_id * 3607 + turn * 60 + (conv_id * 7919 + turn * 104729) % 200000"

SQL: dict[str, str] = {
    "tweets": f"""tweets AS (
  SELECT doc_id AS id_str, {_at("(doc_id % 30) * 86400 + doc_id % 80000")} AS created_at, text AS full_text,
    doc_id % 97 AS user_id, CASE WHEN doc_id % 5 <> 0 THEN doc_id // 3 END AS in_reply_to_status_id_str
  FROM documents)""",
    "questions_raw": f"""questions_raw AS (
  SELECT conv_id * 1000 + turn AS question_id, text || ' v' || v AS question_content, {_at(_QUESTION_TIME)} AS created_date,
    CASE WHEN v > 0 THEN {_at(_QUESTION_TIME + " + v * 3600")} END AS updated,
    'About the ' || role || ' in ' || conv_id AS title,
    CASE conv_id % 3 WHEN 0 THEN 'os Linux' WHEN 1 THEN 'OS X' ELSE '' END AS metadata_array
  FROM conversations {_VERSIONS} WHERE role = 'user')""",
    "answers_raw": f"""answers_raw AS (
  SELECT conv_id * 1000 + turn AS answer_id, question_id, text || ' v' || v AS answer_content,
    {_at(_ANSWER_TIME)} AS created_date, CASE WHEN v > 0 THEN {_at(_ANSWER_TIME + " + v * 3600")} END AS updated
  FROM (SELECT *, max(CASE WHEN role = 'user' THEN conv_id * 1000 + turn END) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS question_id FROM conversations) {_VERSIONS} WHERE role = 'assistant')""",
    "hits": """hits AS (
  SELECT event_id AS hit_id, ts, CAST(ts AS DATE) AS ga_date, user_id,
    user_id || '#' || CAST(ts AS DATE) AS session_id,
    CASE event_type WHEN 'view' THEN '/en-US/kb/topic-' WHEN 'click' THEN '/en-US/questions/'
      WHEN 'signup' THEN '/en-US/kb/topic-' WHEN 'error' THEN '/de/kb/Topic-' ELSE '/en-US/products/' END
      || json_extract_string(props, '$.k')
      || CASE event_type WHEN 'signup' THEN '?from=mail' ELSE '' END AS page_path,
    CASE event_type WHEN 'signup' THEN 'InProduct' ELSE 'web' END AS source,
    CASE event_type WHEN 'purchase' THEN 'organic' ELSE 'none' END AS medium,
    CASE event_type WHEN 'click' THEN 'Result Clicked' WHEN 'view' THEN 'Search' ELSE '' END AS event_action,
    n_name AS country
  FROM events LEFT JOIN nation ON user_id % 25 = n_nationkey)""",
}
SQL["questions"] = SQL["questions_raw"] + """, questions AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY updated DESC NULLS LAST) AS n
    FROM questions_raw) WHERE n = 1)"""
SQL["answers"] = SQL["answers_raw"] + """, answers AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY answer_id ORDER BY updated DESC NULLS LAST) AS n
    FROM answers_raw) WHERE n = 1)"""
SQL["first_responses"] = """first_responses AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY frt NULLS FIRST, a_created_date, answer_id) AS n
    FROM (SELECT a.answer_id, a.question_id, a.created_date AS a_created_date, a.updated AS a_updated,
        q.created_date AS q_created_date, q.updated AS q_updated,
        date_sub('second', q.created_date, a.created_date) AS frt
      FROM answers a LEFT JOIN questions q ON a.question_id = q.question_id WHERE q.created_date IS NOT NULL))
  WHERE n = 1)"""
SQL["reviews"] = """reviews AS (
  SELECT t.*, p.full_text AS in_reply_to_status_text, p.created_at AS in_reply_to_status_created_at,
    p.user_id AS in_reply_to_status_user_id
  FROM tweets t LEFT JOIN tweets p ON t.in_reply_to_status_id_str = p.id_str)"""


def with_inputs(names: str, body: str) -> str:
    return "WITH " + ", ".join(SQL[n] for n in names.split()) + "\n" + body

"""Forum questions and answers: typed rows, latest versions, first responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions.text import escape_newlines
from supportlens.functions.time import seconds_between, source_text_to_utc
from supportlens.operators.skew import first_by


def _text(name: str, default: str = ""):
    return F.coalesce(F.col(name), F.lit(default))


def question_rows(results: DataFrame) -> DataFrame:
    """API question records to the raw question table's columns."""
    return results.select(
        F.col("id").cast("long").alias("question_id"),
        escape_newlines("content").alias("question_content"),
        source_text_to_utc("created").alias("created_date"),
        F.col("creator.username").alias("creator_username"),
        source_text_to_utc("updated").alias("updated"),
        "updated_by",
        F.coalesce("is_solved", F.lit(False)).alias("is_solved"),
        _text("locale").alias("locale"),
        _text("product").alias("product"),
        escape_newlines(_text("title")).alias("title"),
        _text("topic").alias("topic"),
        F.col("solution").cast("long").alias("solution"),
        _text("solved_by").alias("solved_by"),
        F.coalesce("num_votes", F.lit(0)).cast("long").alias("num_votes"),
        F.coalesce("num_votes_past_week", F.lit(0)).cast("long").alias("num_votes_past_week"),
        F.col("last_answer").cast("long").alias("last_answer"),
        _text("metadata").alias("metadata_array"),
        _text("tags").alias("tags_array"),
        _text("answers").alias("answers"),
    )


def answer_rows(results: DataFrame) -> DataFrame:
    """API answer records to the raw answer table's columns."""
    return results.select(
        F.col("id").cast("long").alias("answer_id"),
        F.col("question").cast("long").alias("question_id"),
        escape_newlines("content").alias("answer_content"),
        source_text_to_utc("created").alias("created_date"),
        F.col("creator.username").alias("creator_username"),
        source_text_to_utc("updated").alias("updated"),
        "updated_by",
        "is_spam",
        F.col("num_helpful_votes").cast("long").alias("num_helpful_votes"),
        F.col("num_unhelpful_votes").cast("long").alias("num_unhelpful_votes"),
    )


def latest(raw: DataFrame, key: str, tie_break: list[str] | None = None) -> DataFrame:
    """Last updated version of each key; a version without a date loses to any with one."""
    ties = [F.col(c).desc_nulls_last() for c in tie_break or []]
    return first_by(raw, [key], [F.col("updated").desc_nulls_last(), *ties])


def first_response(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """The first answer of each question and its delay in seconds, over latest versions.

    For one question the delay grows with the answer's time, so the first answer is picked before the join: each
    question then brings one row to it, and both sides are already parted by question.
    """
    first = first_by(
        answers.select(
            "answer_id",
            "question_id",
            F.col("created_date").alias("a_created_date"),
            F.col("updated").alias("a_updated"),
        ).where("question_id is not null"),
        ["question_id"],
        [F.col("a_created_date").asc_nulls_first(), F.col("answer_id").asc()],
    )
    asked = questions.where("created_date is not null").select(
        "question_id", F.col("created_date").alias("q_created_date"), F.col("updated").alias("q_updated")
    )
    return first.join(asked, "question_id").select(
        "answer_id",
        "question_id",
        "a_created_date",
        "a_updated",
        "q_created_date",
        "q_updated",
        seconds_between("q_created_date", "a_created_date").alias("frt"),
    )


def over_deadline(
    questions: DataFrame, responses: DataFrame, seconds: int = values.ANSWER_DEADLINE_SECONDS
) -> DataFrame:
    """Questions with no answer within the deadline. Questions have ids; a row without one is no question and never late.

    NOT IN, written without a broadcast of every answered question, since response keys are never null.
    """
    in_time = responses.where(F.col("frt") <= seconds).select("question_id")
    return questions.where(F.col("question_id").isNotNull()).join(in_time, "question_id", "left_anti")


def repeated_keys(raw: DataFrame, key: str) -> DataFrame:
    """Audit of ids stored more than once."""
    return raw.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")

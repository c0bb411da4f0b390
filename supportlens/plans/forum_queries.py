"""Queries on forum questions and answers, tweets and their replies."""

from __future__ import annotations

from pyspark.sql import functions as F

from supportlens.operators import forum, social
from supportlens.plans.inputs import answer_versions, load, question_versions, tweets, with_inputs
from supportlens.sources.readers import ANSWER_PAGE, QUESTION_PAGE, TWEET, parse_pages
from supportlens.sources.sinks import staging
from supportlens.streaming.latest import merge_all


def _latest_question(spark, sf):
    return forum.latest(question_versions(spark, sf), "question_id")


def _kept_question(spark, sf):
    """The same from batches: the second versions first, then the undated first ones with a part again, then the last ones."""
    raw, v = question_versions(spark, sf), F.substring("question_content", -1, 1)
    batches = [raw.where(v == "1"), raw.where((v == "0") | ((v == "1") & (F.col("question_id") % 3 == 0))), raw.where(v == "2")]
    return merge_all(batches, staging(spark, "kept"), "question_id", buckets=16)


def _latest_answer(spark, sf):
    return forum.latest(answer_versions(spark, sf), "answer_id")


def _first_response(spark, sf):
    return forum.first_response(_latest_question(spark, sf), _latest_answer(spark, sf))


def _over_deadline(spark, sf):
    return forum.over_deadline(_latest_question(spark, sf), _first_response(spark, sf))


def _repeated(spark, sf):
    return forum.repeated_keys(answer_versions(spark, sf), "answer_id")


def _wall():
    shift = "(conv_id * 40009 + turn * 1801) * interval '1' second"
    return F.date_format(F.expr("timestamp_ntz'2020-10-20 00:00:00' + " + shift), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _question_rows(spark, sf):
    """Turns of users as API pages of one record, then the reader's way back to rows."""
    record = F.struct(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("text").alias("content"),
        _wall().alias("created"),
        F.struct(F.col("role").alias("username")).alias("creator"),
        _wall().alias("updated"),
        F.col("role").alias("updated_by"),
        F.when(F.col("turn") > 0, F.col("turn") > 2).alias("is_solved"),
        F.when(F.col("turn") > 0, F.col("text")).alias("title"),
        F.when(F.col("turn") > 2, F.col("turn")).alias("num_votes"),
    )
    pages = load(spark, sf, "conversations").where("role = 'user'").select(
        F.to_json(F.struct(F.lit(1).alias("count"), F.array(record).alias("results"))).alias("value")
    )
    return forum.question_rows(parse_pages(pages, QUESTION_PAGE, "results")).drop("solution", "last_answer")


def _answer_rows(spark, sf):
    record = F.struct(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("conv_id").alias("question"),
        F.col("text").alias("content"),
        _wall().alias("created"),
        F.struct(F.col("role").alias("username")).alias("creator"),
        _wall().alias("updated"),
        F.col("role").alias("updated_by"),
        (F.col("turn") > 5).alias("is_spam"),
        F.col("turn").alias("num_helpful_votes"),
        (F.col("turn") - 1).alias("num_unhelpful_votes"),
    )
    pages = load(spark, sf, "conversations").where("role = 'assistant'").select(
        F.to_json(F.struct(F.lit(1).alias("count"), F.array(record).alias("results"))).alias("value")
    )
    return forum.answer_rows(parse_pages(pages, ANSWER_PAGE, "results"))


def _tweet_rows(spark, sf):
    objects = tweets(spark, sf).select(
        F.to_json(
            F.struct(
                F.col("id_str").cast("string").alias("id_str"),
                F.col("created_at").cast("string").alias("created_at"),
                "full_text",
                F.struct(F.col("user_id").alias("id")).alias("user"),
                F.col("in_reply_to_status_id_str").cast("string").alias("in_reply_to_status_id_str"),
            )
        ).alias("value")
    )
    return social.tweet_rows(objects.select(F.from_json("value", TWEET).alias("t")).select("t.*"))


def _reviews(spark, sf):
    posts = tweets(spark, sf)
    return social.enrich_replies(posts, posts)


def _reply_first(spark, sf):
    reviews = _reviews(spark, sf).drop("full_text", "in_reply_to_status_text")
    return social.reply_first_response(reviews)


QUERIES = {
    "latest_question": _latest_question,
    "latest_question_kept": _kept_question,
    "latest_answer": _latest_answer,
    "question_first_response": _first_response,
    "over_24h_response": _over_deadline,
    "duplicate_audit": _repeated,
    "question_rows": _question_rows,
    "answer_rows": _answer_rows,
    "tweet_rows": _tweet_rows,
    "reply_enrich": _reviews,
    "reply_first_response": _reply_first,
}

_UTC = """(TIMESTAMP '2020-10-20 00:00:00' + to_seconds(conv_id * 40009 + turn * 1801))
    AT TIME ZONE 'America/Los_Angeles' AT TIME ZONE 'UTC'"""
_LF = r"chr(10), '\n'"

ORACLE = {
    "latest_question": with_inputs("questions", "SELECT * FROM questions"),
    "latest_question_kept": with_inputs("questions", "SELECT * FROM questions"),
    "latest_answer": with_inputs("answers", "SELECT * FROM answers"),
    "question_first_response": with_inputs("questions answers first_responses", "SELECT * FROM first_responses"),
    "over_24h_response": with_inputs("questions answers first_responses", """SELECT * FROM questions
WHERE question_id NOT IN (SELECT question_id FROM first_responses WHERE frt <= 86400)"""),
    "duplicate_audit": with_inputs("answers_raw", """SELECT answer_id, count(*) AS copies FROM answers_raw
GROUP BY answer_id HAVING count(*) > 1"""),
    "question_rows": f"""SELECT conv_id * 1000 + turn AS question_id, replace(text, {_LF}) AS question_content,
  {_UTC} AS created_date, role AS creator_username, {_UTC} AS updated, role AS updated_by,
  turn > 2 AS is_solved, '' AS locale, '' AS product, CASE WHEN turn > 0 THEN replace(text, {_LF}) ELSE '' END AS title,
  '' AS topic, '' AS solved_by, CASE WHEN turn > 2 THEN turn ELSE 0 END AS num_votes, CAST(0 AS BIGINT) AS num_votes_past_week,
  '' AS metadata_array, '' AS tags_array, '' AS answers
FROM conversations WHERE role = 'user'""",
    "answer_rows": f"""SELECT conv_id * 1000 + turn AS answer_id, conv_id AS question_id,
  replace(text, {_LF}) AS answer_content, {_UTC} AS created_date, role AS creator_username, {_UTC} AS updated,
  role AS updated_by, turn > 5 AS is_spam, turn AS num_helpful_votes, turn - 1 AS num_unhelpful_votes
FROM conversations WHERE role = 'assistant'""",
    "tweet_rows": with_inputs("tweets", f"""SELECT id_str, created_at, replace(full_text, {_LF}) AS full_text, user_id,
  in_reply_to_status_id_str FROM tweets"""),
    "reply_enrich": with_inputs("tweets reviews", "SELECT * FROM reviews"),
    "reply_first_response": with_inputs("tweets reviews", """
, timed AS (SELECT * EXCLUDE (full_text, in_reply_to_status_text),
    date_sub('second', in_reply_to_status_created_at, created_at) AS response_time FROM reviews)
SELECT t.* FROM timed t JOIN (SELECT in_reply_to_status_id_str, min(response_time) AS fastest FROM timed GROUP BY 1) f
  ON t.in_reply_to_status_id_str = f.in_reply_to_status_id_str AND t.response_time = f.fastest"""),
}

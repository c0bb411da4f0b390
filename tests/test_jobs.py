"""The scheduled loads, each run twice."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from supportlens import jobs, schemas, values
from supportlens.operators import web
from test_operators import MENTION, frame, tuples
from test_web import HIT, ROWS


@pytest.fixture(scope="module")
def db(spark):
    spark.sql("create database if not exists jobs")
    return "jobs"


def store(spark, name, rows, schema):
    frame(spark, rows, schema).write.mode("overwrite").saveAsTable(name)


ENGLISH = "the app is slow and it was not for you"


def test_tweets(spark, db):
    rules = spark.createDataFrame([("slow", "slow")], "topic string, keywords string")
    posts = [(1, "2020-01-01", ENGLISH, 5, None), (2, "2020-01-02", "Ikke", 5, None), (3, "2020-01-05", ENGLISH, 5, 2**60 + 1)]
    store(spark, "jobs.mentions", posts, MENTION)

    def load(end):
        jobs.load_tweet_sentiment(spark, "jobs.mentions", "jobs.tweet_sentiment", rules, "jobs.topic_rules", end)
        return tuples(spark.table("jobs.tweet_sentiment"), "id_str", "in_reply_to_status_id_str")

    assert load(datetime(2020, 1, 3)) == [(1, None)]
    assert load(datetime(2020, 1, 3)) == [(1, None)]
    assert load(datetime(2020, 1, 5)) == [(1, None), (3, 2**60 + 1)]
    topics = spark.table("jobs.tweet_sentiment").select(F.col("topics.topic").alias("t")).first()["t"]
    assert topics == ["", "slow"]


def test_questions(spark, db):
    schema = schemas.TABLES["forum_questions_raw"]
    empty = spark.createDataFrame([tuple([None] * len(schema))], schema)
    asked = empty.withColumns(
        {"question_id": F.lit(1).cast("long"), "title": F.lit(ENGLISH), "question_content": F.lit("<b>norton</b>"),
         "created_date": F.expr("timestamp_ntz'2020-01-01 05:00:00'"), "metadata_array": F.lit("linux")}
    )
    asked.write.mode("overwrite").saveAsTable("jobs.questions")
    for _ in range(2):
        jobs.load_question_sentiment(spark, "jobs.questions", "jobs.question_sentiment", datetime(2020, 1, 2))
        jobs.load_keyword_counts(spark, "jobs.questions", "jobs.keywords", date(2020, 1, 2))
    assert tuples(spark.table("jobs.question_sentiment"), "question_content", "discrete_sentiment") == [("norton", "negativ")]
    assert tuples(spark.table("jobs.keywords"), "forum_word", "forum_freq") == [("linux", 1), ("norton", 1)]


def test_terms(spark, db):
    store(spark, "jobs.posts", [(1, "2020-01-01", "slow Slow", 5, None), (2, "2020-01-02", "slow", 5, None)], MENTION)
    for end in (2, 2, 3, 3):
        jobs.load_term_counts(spark, "jobs.posts", "jobs.terms", date(2020, 1, end), values.stop_terms())
    counts = tuples(spark.table("jobs.terms"), "tweet_dt", "tweet_freq")
    assert counts == [(date(2020, 1, 1), 2), (date(2020, 1, 2), 1)]


def test_web_reports(spark, db):
    hits = frame(spark, ROWS, HIT)

    def load(end, *names):
        jobs.load_web_reports(spark, hits, "jobs", date(2020, 1, 1), date(2020, 1, end), {n: web.KB_PAGES for n in names})
        tables = [*jobs.WEB_REPORTS, *jobs.PRODUCT_REPORTS]
        return {t: spark.table(f"jobs.{t}").count() for t in tables}

    first = load(2, "a")
    assert load(2, "a") == first and all(first.values())
    both = load(3, "a", "b")
    assert load(3, "a", "b") == both
    whole = web.exit_rates(hits)
    for product in ("a", "b"):
        rows = spark.table("jobs.ga_kb_exit_rate_by_product").where(F.col("product") == product)
        assert tuples(rows, *whole.columns) == tuples(whole, *whole.columns)


def test_trends(spark, db):
    calls = []

    def fetch(start, end):
        calls.append((start, end))
        queries = spark.createDataFrame([("DE", "q", 5)], "region string, query string, value long")
        return queries, frame(spark, [("DE", "2020-01-01", 7)], "region string, date ntz, q long"), ["q"]

    words = spark.createDataFrame([], "original_query string, translated_query string")
    for day in (8, 9, 14):
        jobs.load_trends(spark, fetch, words, "jobs.trend_q", "jobs.trend_s", date(2020, 1, day))
    assert calls == [(date(2019, 12, 30), date(2020, 1, 6)), (date(2020, 1, 6), date(2020, 1, 13))]
    assert spark.table("jobs.trend_q").count() == 2 and spark.table("jobs.trend_s").count() == 2


def test_calendar_and_reviews(spark, db, tmp_path):
    text = '{"releases": {"a-1": {"product": "a", "version": "60.0", "date": "2020-01-01", "build_number": 1}}}'
    for _ in range(2):
        jobs.load_release_calendar(spark, spark.createDataFrame([(text,)], "value string"), "jobs.calendar")
    assert spark.table("jobs.calendar").count() == 84
    names = schemas.TABLES["store_reviews"].names
    row = {n: "" for n in names} | {"Review_Last_Update_Date_and_Time": "2020-01-31T10:00:00", "Review_Text": '"a, b"'}
    export = tmp_path / "reviews.csv"
    export.write_bytes((",".join(names) + "\n" + ",".join(row.values()) + "\n").encode("utf-16"))
    for _ in range(2):
        jobs.load_store_reviews(spark, str(export), str(tmp_path / "out"))
    assert tuples(spark.read.parquet(str(tmp_path / "out")), "Review_Text", "month") == [("a  b", "2020-01")]


def write_lines(path, *records):
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(map(json.dumps, records)))
    return str(path)


def tweet(id_, text="x", parent=None, at="2020-01-01 00:00:00"):
    return {"id_str": str(id_), "created_at": at, "full_text": text, "user": {"id": 5}, "in_reply_to_status_id_str": parent and str(parent)}


def test_raw_mentions_and_replies(spark, db, tmp_path):
    path = write_lines(tmp_path / "t", tweet(1), tweet(2, "y", 1), tweet(2, "y", 1))
    for wanted in (2, 2):
        jobs.load_mentions(spark, path, "jobs.raw_mentions")
        jobs.load_replies(spark, path, "jobs.raw_mentions", "jobs.raw_replies")
        assert spark.table("jobs.raw_mentions").count() == spark.table("jobs.raw_replies").count() == wanted
    write_lines(tmp_path / "t", tweet(3, "z", 2, "2020-01-02 00:00:00"))
    jobs.load_mentions(spark, path, "jobs.raw_mentions")
    jobs.load_replies(spark, path, "jobs.raw_mentions", "jobs.raw_replies")
    told = tuples(spark.table("jobs.raw_replies"), "id_str", "in_reply_to_status_text")
    assert told == [(1, None), (2, "x"), (3, "y")]


def test_raw_questions_and_answers(spark, db, tmp_path):
    def page(*records):
        return {"count": 1, "results": list(records)}

    def post(id_, updated, **more):
        return {"id": id_, "content": "c", "created": "2020-01-01T00:00:00Z", "updated": updated, "creator": {"username": "u"}, **more}

    first = [post(1, "2020-01-01T05:00:00Z"), post(2, "2020-01-01T23:30:00Z"), post(2, "2020-01-01T23:30:00Z"), post(3, None)]
    q = write_lines(tmp_path / "q", page(*first))
    a = write_lines(tmp_path / "a", page(*[{**p, "question": 9} for p in first]))
    for _ in range(2):
        jobs.load_questions(spark, q, "jobs.raw_questions")
        jobs.load_answers(spark, a, "jobs.raw_answers")
        assert spark.table("jobs.raw_questions").count() == spark.table("jobs.raw_answers").count() == 3
    write_lines(tmp_path / "q", page(post(1, "2020-01-03T00:00:00Z"), post(4, "2020-01-01T23:45:00Z")))
    jobs.load_questions(spark, q, "jobs.raw_questions")
    assert sorted(r["question_id"] for r in spark.table("jobs.raw_questions").collect()) == [1, 1, 2, 3, 4]


def test_raw_survey_and_its_export(spark, db, tmp_path):
    def response(id_, at):
        return {"id": str(id_), "date_started": at, "date_submitted": at, "status": "Complete", "survey_data": {"2": {"answer": "Yes"}}}

    path = write_lines(tmp_path / "s", {"data": [response(1, "2020-01-01 10:00:00 EST"), response(2, "some day"), response(3, "2020-01-02 10:00:00 EST")]})
    for _ in range(2):
        jobs.load_survey(spark, path, "jobs.survey", str(tmp_path / "aside"))
        assert tuples(spark.table("jobs.survey"), "response_id") == [(1,), (3,)]
        assert [r["id"] for r in spark.read.json(str(tmp_path / "aside")).collect()] == ["2"]
    jobs.export_survey(spark, path, str(tmp_path / "out"), datetime(2020, 1, 3))
    assert [r["id"] for r in spark.read.csv(str(tmp_path / "out"), header=True).collect()] == ["3"]


def test_trends_after_a_failure_between_the_tables(spark, db, monkeypatch):
    queries = spark.createDataFrame([("DE", "q", 5)], "region string, query string, value long")
    wide = frame(spark, [("DE", "2020-01-01", False, 7)], "region string, date ntz, isPartial boolean, q long")
    words = spark.createDataFrame([("q", "b"), ("q", "a")], "original_query string, translated_query string")

    def load():
        jobs.load_trends(spark, lambda *_: (queries, wide, ["q"]), words, "jobs.broken_q", "jobs.broken_s", date(2020, 1, 15))

    append = jobs.sinks.append
    monkeypatch.setattr(jobs.sinks, "append", lambda df, name, table: append(df, name, table) if table == "trend_timeseries" else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load()
    monkeypatch.undo()
    for _ in range(2):
        load()
        assert tuples(spark.table("jobs.broken_q"), "translated_query") == [("a",)]
        assert spark.table("jobs.broken_s").count() == 1


@pytest.mark.parametrize("table, column", [("twitter_mentions", "created_at"), ("ga_total_users", "ga_date"), ("twitter_word_frequencies", "tweet_dt")])
def test_watermarks_read_days(spark, db, table, column):
    name = f"jobs.by_day_{table}"
    jobs.sinks.ensure_table(spark, name, table)
    days = spark.table(name).where(F.col(f"{column}_day") == F.lit(date(2020, 1, 1)))
    assert "PartitionFilters: [isnotnull(" in days._jdf.queryExecution().executedPlan().toString()

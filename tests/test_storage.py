"""Readers, writers and file streams over real folders."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from supportlens import schemas, values
from supportlens.operators import forum, incremental, survey
from supportlens.sources import readers, sinks
from supportlens.streaming import files
from test_operators import frame, tuples


def write(folder, name, text, encoding="utf-8"):
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder / name)


def test_question_pages(spark, tmp_path):
    full = {
        "id": 1, "content": "a\nb", "created": "2020-04-09T13:13:42Z", "creator": {"username": "u"},
        "updated": "2020-04-10T00:00:00Z", "updated_by": "v", "is_solved": True, "title": "t\nu", "num_votes": 3,
        "tags": [{"name": "x"}], "answers": [5, 6], "solution": 5,
    }
    bare = {"id": 2, "content": "", "created": "2020-04-09T13:13:42Z", "creator": {"username": "u"}, "updated": "", "updated_by": None}
    pages = [{"count": 2, "results": [full]}, {"count": 2, "results": [bare]}, {"count": 2, "results": []}]
    path = write(tmp_path, "pages.json", "\n".join(map(json.dumps, pages)))
    rows = forum.question_rows(readers.read_pages(spark, path, readers.QUESTION_PAGE, "results"))
    assert rows.schema.names == schemas.TABLES["forum_questions_raw"].names
    first, second = rows.orderBy("question_id").collect()
    assert (first["question_content"], first["title"], first["created_date"]) == ("a\\nb", "t\\nu", datetime(2020, 4, 9, 20, 13, 42))
    assert (first["answers"], first["tags_array"], first["solution"]) == ("[5,6]", '[{"name":"x"}]', 5)
    assert (second["is_solved"], second["locale"], second["num_votes"], second["updated"]) == (False, "", 0, None)


def test_survey_pages(spark, tmp_path):
    def record(number, when, answers):
        return {"id": str(number), "date_started": when, "date_submitted": when, "status": "Complete", "longitude": "1.5", "survey_data": answers}

    good = record(1, "2019-07-13 23:49:22 EDT", {"2": {"answer": "Yes"}, "4": {"question": "q"}})
    page = {"total_pages": 1, "data": [good, record(2, "", {}), record(3, "2019-12-13 01:00:00 EST", {})]}
    path = write(tmp_path, "survey.json", json.dumps(page))
    rows = survey.survey_rows(readers.read_pages(spark, path, readers.SURVEY_PAGE, "data"))
    assert rows.schema.names == schemas.TABLES["survey_responses"].names
    assert tuples(rows, "response_id", "date_submitted", "goal_accomplished", "rating", "longitude") == [
        (1, datetime(2019, 7, 14, 3, 49, 22), "Yes", "", 1.5),
        (3, datetime(2019, 12, 13, 6, 0), "", "", 1.5),
    ]


MENTIONS = schemas.TABLES["twitter_mentions"]


def test_csv_and_bad_rows(spark, tmp_path):
    text = 'id_str,created_at,full_text,user_id,in_reply_to_status_id_str\n1,2020-01-01 00:00:00,"a ""b"", c",5,\nx,y,z,u,v\n'
    rows = readers.read_csv(spark, write(tmp_path, "m.csv", text), MENTIONS)
    good = readers.check_bad_rows(rows, 1, str(tmp_path / "bad")).collect()
    assert [r["_corrupt"] for r in spark.read.json(str(tmp_path / "bad")).collect()] == ["x,y,z,u,v"]
    assert [tuple(r) for r in good] == [(1, datetime(2020, 1, 1), 'a "b", c', 5, None)]
    with pytest.raises(Exception, match="more than 0 bad rows"):
        readers.check_bad_rows(rows, 0).collect()
    with pytest.raises(ValueError, match="more than 1 bad rows"):
        readers.check_bad_rows(rows.union(rows), 1, str(tmp_path / "worse"))


def test_utf16_reviews(spark, tmp_path):
    schema = schemas.table("Package_Name: string, Star_Rating: long, Review_Text: string")
    path = write(tmp_path, "r.csv", 'Package_Name,Star_Rating,Review_Text\norg.app,5,"良い、\nとても"\n', "utf-16")
    rows = readers.read_store_reviews(spark, path, schema).collect()
    assert [tuple(r) for r in rows] == [("org.app", 5, "良い、\nとても")]


def test_rules_words_and_urls(spark, tmp_path):
    rules = readers.read_rules(spark, write(tmp_path, "rules.tsv", "topic\tkeywords\ntest topic 1\ttest keywords 1\n"))
    assert readers.rule_list(rules) == [("test topic 1", "test keywords 1")]
    words = readers.read_lines(spark, write(tmp_path, "words.txt", "der  \n\ndie\n"))
    assert sorted(readers.word_list(words)) == ["der", "die"]
    with pytest.raises(ValueError, match="more than 1 words"):
        readers.word_list(words, most=1)


def test_database_query():
    assert readers.mirror_query("wiki_locale") == "id, locale"


def test_report_and_tweet_files(spark, tmp_path):
    path = write(tmp_path, "t.json", json.dumps({"id_str": "1", "full_text": "x", "user": {"id": 2}}))
    assert readers.read_tweets(spark, path).first()["user"]["id"] == 2
    path = write(tmp_path, "r.json", json.dumps({"reports": [{"data": {"rows": []}}]}))
    assert readers.read_reports(spark, path).count() == 1


SENTIMENT = schemas.TABLES["forum_sentiment_scores"]


def scores(spark, *ids):
    return spark.createDataFrame([(i, 0.5, 1.0, "positive", "t") for i in ids], SENTIMENT)


def test_tables(spark):
    spark.sql("create database if not exists support")
    assert sinks.ensure_all(spark, "support") == list(schemas.TABLES)
    stored = sinks.plain(spark.table("support.twitter_sentiment"))
    assert [f.dataType for f in stored.schema] == [f.dataType for f in schemas.TABLES["twitter_sentiment"]]
    name = "support.forum_sentiment_scores"
    sinks.append(scores(spark, 1), name, "forum_sentiment_scores")
    sinks.append(scores(spark, 1), name, "forum_sentiment_scores")
    assert spark.table(name).count() == 2
    sinks.append_new(scores(spark, 1, 2), name, "forum_sentiment_scores", ["question_id"])
    sinks.append_new(scores(spark, 1, 2), name, "forum_sentiment_scores", ["question_id"])
    assert tuples(spark.table(name), "question_id") == [(1,), (1,), (2,)]
    sinks.overwrite(scores(spark, 7).select(*reversed(SENTIMENT.names)), name, "forum_sentiment_scores")
    assert tuples(spark.table(name), "question_id", "topic") == [(7, "t")]
    with pytest.raises(ValueError, match="do not fit"):
        sinks.append(scores(spark, 1).drop("topic"), name, "forum_sentiment_scores")


def test_a_batch_is_made_once(spark):
    spark.sql("create database if not exists support")
    name, columns = "support.posts_made_once", "id_str long, created_at ntz, full_text string, user_id long, in_reply_to_status_id_str long"
    sinks.ensure_table(spark, name, "twitter_mentions")
    made = spark.sparkContext.accumulator(0)

    def note(text):
        made.add(1)
        return text

    rows = [(i, f"2020-01-0{1 + i % 3} 10:00:00", "x", 1, None) for i in range(30)] + [(90, None, "x", 1, None)]
    for load in (1, 2):
        batch = frame(spark, rows, columns).withColumn("full_text", F.udf(note, "string")("full_text"))
        sinks.append_new(batch, name, "twitter_mentions", ["id_str"])
        assert made.value == load * len(rows)
    assert spark.table(name).count() == len(rows)


def test_tables_by_day(spark):
    spark.sql("create database if not exists support")
    name, columns = "support.posts_by_day", "id_str long, created_at ntz, full_text string, user_id long, in_reply_to_status_id_str long"
    sinks.ensure_table(spark, name, "twitter_mentions")
    assert sinks.stored_watermark(spark, name, "created_at", "2010-05-01") == datetime(2010, 5, 1)
    days = [(1, "2020-01-01 23:00:00"), (2, "2020-01-02 01:00:00"), (3, "2020-01-02 02:00:00"), (4, None)]
    sinks.append(frame(spark, [(i, at, "x", 1, None) for i, at in days], columns), name, "twitter_mentions")
    assert sinks.stored_watermark(spark, name, "created_at") == datetime(2020, 1, 2, 2)
    scan = incremental.scan_range(spark.table(name), "created_at", "2020-01-01 23:00:00", "2020-01-02 01:00:00", ordered=False)
    assert tuples(sinks.plain(scan), "id_str") == [(2,)]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_at_day" in plan and "PushedFilters: [IsNotNull(created_at)" in plan
    new = frame(spark, [(9, "2020-01-03 00:00:00", "x", 1, None)], columns)
    sinks.overwrite(new, name, "twitter_mentions")
    assert tuples(spark.table(name), "id_str", "created_at_day") == [(9, date(2020, 1, 3))]


def test_rule_sync(spark):
    spark.sql("create database if not exists support")
    rules = spark.createDataFrame(values.topic_rules("Acme"), "topic string, keywords string")
    assert sinks.sync_rules(spark, rules, "support.rules")
    assert not sinks.sync_rules(spark, rules, "support.rules")
    assert sinks.sync_rules(spark, rules.limit(5), "support.rules") and spark.table("support.rules").count() == 5


def test_month_files(spark, tmp_path):
    path = str(tmp_path / "reviews")
    first = frame(spark, [(1, "2020-01-31 23:00:00"), (2, "2020-02-01 00:00:00")], "id long, ts ntz")
    sinks.write_months(first, path, "ts")
    sinks.write_months(frame(spark, [(3, "2020-01-01 00:00:00")], "id long, ts ntz"), path, "ts")
    assert tuples(spark.read.parquet(path), "id") == [(2,), (3,)]


def test_staged_files(spark, tmp_path):
    rows = frame(spark, [(1, "2020-01-01 05:00:00", 'a "b"\nc', None)], "id long, ts ntz, t string, n long")
    sinks.write_ndjson(rows, str(tmp_path / "j"))
    line = spark.read.text(str(tmp_path / "j")).first()["value"]
    assert json.loads(line) == {"id": 1, "ts": "2020-01-01T05:00:00.000", "t": 'a "b"\nc'}
    schema = schemas.table("id: long, ts: timestamp, t: string, n: long")
    for sep, quote_all in ((",", True), ("|", False)):
        path = str(tmp_path / f"c{quote_all}")
        sinks.write_csv(rows, path, sep, quote_all)
        back = readers.read_csv(spark, path, schema, sep=sep, multi_line=True).drop("_corrupt")
        assert tuple(back.first()) == tuple(rows.first())


def test_loaded_rows_are_counted_on_the_way(spark, tmp_path):
    rows, seen = sinks.counted(scores(spark, 1, 2, 3))
    rows.write.parquet(str(tmp_path / "s"))
    assert seen.get["loaded"] == 3


def test_streamed_load_runs_once_and_archives(spark, tmp_path):
    from supportlens.operators.enrich import enrich_tweets

    source, archive = tmp_path / "in", tmp_path / "processed"
    source.mkdir()
    line = {"id_str": 1, "created_at": "2020-01-01 00:00:00", "full_text": "the app is slow and it was not for you", "user_id": 3}
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def load():
        stream = files.file_stream(spark, str(source), MENTIONS, str(archive))
        query = files.load_available(stream, lambda df: enrich_tweets(df, [("slow", "slow")]), out, state)
        assert query.awaitTermination(120)

    write(source, "a.json", json.dumps(line))
    load()
    load()
    assert spark.read.parquet(out).count() == 1
    write(source, "b.json", json.dumps({**line, "id_str": 2}))
    load()
    write(source, "c.json", json.dumps({**line, "id_str": 3}))
    load()
    assert tuples(spark.read.parquet(out), "id_str") == [(1,), (2,), (3,)]
    assert list(archive.rglob("a.json")) and not (source / "a.json").exists()


def test_streamed_terms(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines = [{"id_str": i, "created_at": f"2020-01-0{d} 08:00:00", "full_text": "Slow slow app"} for i, d in enumerate((1, 1, 9))]
    write(source, "a.json", "\n".join(map(json.dumps, lines)))
    stream = files.file_stream(spark, str(source), MENTIONS)
    out = str(tmp_path / "out")
    query = files.load_available(stream, lambda df: files.daily_terms(df, "created_at", "full_text", "2 days", ["app"]), out, str(tmp_path / "state"))
    assert query.awaitTermination(120)
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(date(2020, 1, 1), "slow", 4)]


def test_rows_too_late_for_their_day(spark):
    counted = spark.createDataFrame([(date(2020, 1, 1), "slow", 4)], "tweet_dt date, tweet_word string, tweet_freq long")
    batch = frame(spark, [(1, "2020-01-01 09:00:00"), (2, "2020-01-02 09:00:00")], "id long, at ntz")
    assert tuples(files.too_late(batch, counted, "at"), "id") == [(1,)]


def test_months_need_times(spark, tmp_path):
    rows = frame(spark, [(1, None)], "id long, at ntz")
    with pytest.raises(Exception, match="a row without at"):
        sinks.write_months(rows, str(tmp_path / "m"), "at")


def test_models_see_whole_texts_and_load_once_a_task(spark):
    from supportlens.operators import enrich

    def loader():
        import pandas as pd

        calls = []

        def model(texts):
            calls.append(1)
            return pd.DataFrame({"n": texts.str.len(), "calls": len(calls)})

        return model

    df = spark.range(6).selectExpr("id", "repeat('x', 9000) AS text").repartition(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        rows = enrich.model_step(None, "n long, calls long", loader=loader)(df, F.col("text")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["n"] for r in rows} == {9000} and max(r["calls"] for r in rows) == 3

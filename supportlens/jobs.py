"""The scheduled loads: each reads what is new since the stored table's watermark, and appends it.

Run again at once, a load adds nothing. Every job is one lazy plan from scan to write; the only values that reach the
driver are watermarks and the topic rules.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supportlens import schemas
from supportlens.functions.time import collection_week, from_utc, ntz, survey_text_to_utc
from supportlens.operators import enrich, forum, incremental, releases, reviews, social, survey, terms, trends, web
from supportlens.sources import readers, sinks


def load_tweet_sentiment(
    spark: SparkSession,
    mentions: str,
    target: str,
    rules: DataFrame,
    rules_table: str,
    end: datetime,
    language: enrich.Step = enrich.detect_language,
    sentiment: enrich.Step = enrich.score_sentiment,
    first: datetime | None = None,
) -> None:
    """New mentions up to `end`, detected, filtered, scored, classified by the rules (stored if they changed). The first
    load takes all mentions, or those after `first`."""
    sinks.ensure_table(spark, target, "twitter_sentiment")
    start = sinks.stored_watermark(spark, target, "created_at", first)
    sinks.sync_rules(spark, rules, rules_table)
    new = sinks.plain(incremental.scan_range(spark.table(mentions), "created_at", start, end, ordered=False))
    rich = enrich.enrich_tweets(new, readers.rule_list(spark.table(rules_table)), language, sentiment)
    sinks.append(rich, target, "twitter_sentiment")


def load_question_sentiment(
    spark: SparkSession,
    questions: str,
    target: str,
    end: datetime,
    language: enrich.Step = enrich.detect_language,
    sentiment: enrich.Step = enrich.score_sentiment,
    first: datetime | None = None,
) -> None:
    """Questions asked since the last load and up to `end`, detected, filtered and scored, once each in their latest
    version. The first load takes all questions, or those after `first`."""
    sinks.ensure_table(spark, target, "forum_sentiment")
    start = sinks.stored_watermark(spark, target, "created_date", first)
    stored = _updated_from(spark.table(questions), start)
    new = sinks.plain(incremental.scan_range(stored, "created_date", start, end, ordered=False))
    new = forum.latest(new, "question_id", new.columns)
    sinks.append(enrich.enrich_questions(new, language, sentiment), target, "forum_sentiment")


def load_mentions(spark: SparkSession, path: str, target: str) -> None:
    """New posts of saved tweet objects: those past the greatest id stored, each once."""
    stored = sinks.ensure_table(spark, target, "twitter_mentions")
    rows = social.tweet_rows(readers.read_tweets(spark, path))
    new = incremental.since(rows, "id_str", incremental.read_watermark(stored, "id_str"))
    sinks.append_new(new, target, "twitter_mentions", ["id_str"])


def load_replies(spark: SparkSession, path: str, posts: str, target: str) -> None:
    """New posts of saved tweet objects with the post they answer, looked up in the table `posts`."""
    stored = sinks.ensure_table(spark, target, "twitter_reviews")
    rows = social.tweet_rows(readers.read_tweets(spark, path))
    new = incremental.since(rows, "id_str", incremental.read_watermark(stored, "id_str"))
    sinks.append_new(social.enrich_replies(new, sinks.plain(spark.table(posts))), target, "twitter_reviews", ["id_str"])


def _load_pages(spark: SparkSession, rows: DataFrame, target: str, table: str, key: str) -> None:
    """Versions updated from the source-zone day of the last stored update on, or not dated; each stored once."""
    stored = sinks.ensure_table(spark, target, table)
    start = incremental.source_day(stored, "updated").first()["start"] if stored.take(1) else None
    if start is not None:
        rows = rows.where(F.col("updated").isNull() | (from_utc(F.col("updated")).cast("date") >= F.lit(start)))
    sinks.append_new(rows, target, table, [key, "updated"])


def load_questions(spark: SparkSession, path: str, target: str) -> None:
    """Saved pages of forum questions, the versions not stored yet."""
    rows = forum.question_rows(readers.read_pages(spark, path, readers.QUESTION_PAGE, "results"))
    _load_pages(spark, rows, target, "forum_questions_raw", "question_id")


def load_answers(spark: SparkSession, path: str, target: str) -> None:
    """Saved pages of forum answers, the versions not stored yet."""
    rows = forum.answer_rows(readers.read_pages(spark, path, readers.ANSWER_PAGE, "results"))
    _load_pages(spark, rows, target, "forum_answers_raw", "answer_id")


def load_survey(spark: SparkSession, path: str, target: str, aside: str) -> None:
    """Saved survey pages: responses submitted since the last stored one, that time included, each once. Records whose times
    can't be read are kept in the folder `aside`."""
    sinks.ensure_table(spark, target, "survey_responses")
    pages = sinks.staged(readers.read_pages(spark, path, readers.SURVEY_PAGE, "data"), "survey-pages")
    sinks.write_ndjson(survey.unread_rows(pages), aside)
    mark = sinks.stored_watermark(spark, target, "date_submitted")
    rows = survey.survey_rows(pages)
    if mark is not None:
        rows = rows.where(F.col("date_submitted") >= ntz(mark))
    sinks.append_new(rows, target, "survey_responses", ["response_id"])


def export_survey(spark: SparkSession, path: str, out: str, end: datetime, start: datetime | None = None) -> None:
    """Saved survey pages to CSV as they came: responses submitted in [start, end), by default the day before `end`."""
    pages = readers.read_pages(spark, path, readers.SURVEY_PAGE, "data")
    timed = pages.withColumn("_at", survey_text_to_utc("date_submitted", True))
    sinks.write_csv(survey.export_rows(incremental.scan_submitted(timed, "_at", end, start)), out)


def _updated_from(questions: DataFrame, start: datetime | date | None) -> DataFrame:
    """Of questions stored by their last update, those that can have been asked after `start`: no update comes before."""
    if start is None or "updated_day" not in questions.columns:
        return questions
    day = F.col("updated_day")
    return questions.where(day.isNull() | (day >= ntz(start).cast("date")))


def _open_days(spark: SparkSession, name: str, day: str, first: date | None, end: date) -> tuple[date | None, date] | None:
    """Days of [first, end) after the last one stored, all days before `end` without either; None if there are none."""
    loaded = sinks.stored_watermark(spark, name, day)
    if first is None and loaded is None:
        return None, end
    return incremental.next_window(first or date.min, end, loaded)


def load_term_counts(
    spark: SparkSession, mentions: str, target: str, end: date, ignore: Sequence[str], first: date | None = None
) -> None:
    """Daily term counts of all days not counted yet, `end` exclusive. A day is counted once: mentions that arrive after
    their day was counted are left out, so `end` should stay behind the load of mentions."""
    sinks.ensure_table(spark, target, "twitter_word_frequencies")
    days = _open_days(spark, target, "tweet_dt", first, end)
    if days:
        new = incremental.scan_days(spark.table(mentions), "created_at", *days, ["full_text"])
        sinks.append(terms.term_counts(new, F.col("day"), "full_text", ignore), target, "twitter_word_frequencies")


def load_keyword_counts(spark: SparkSession, questions: str, target: str, end: date, first: date | None = None) -> None:
    """Daily keyword counts of all days not counted yet, `end` exclusive; a question counts once, in its latest version."""
    sinks.ensure_table(spark, target, "forum_word_frequencies")
    days = _open_days(spark, target, "forum_dt", first, end)
    if days:
        columns = ["created_date", "question_content", "title", "metadata_array"]
        asked = forum.latest(_updated_from(spark.table(questions), days[0]), "question_id")
        new = incremental.scan_days(asked, "created_date", *days, columns)
        sinks.append(terms.keyword_counts(new), target, "forum_word_frequencies")


# Table of each web report and what fills it; the product reports take each product's pages besides.
WEB_REPORTS: dict[str, Callable[..., DataFrame]] = {
    "ga_total_users": web.total_users,
    "ga_total_users_kb": web.kb_users,
    "ga_users_by_country": web.users_by_country,
    "ga_inproduct_vs_organic": web.traffic_segments,
    "ga_kb_exit_rate": lambda hits: web.exit_rates(hits, ordered=False),
    "ga_questions_exit_rate": lambda hits: web.exit_rates(hits, web.QUESTION_PAGES, ordered=False),
    "ga_search_ctr": web.search_clicks,
}
PRODUCT_REPORTS: dict[str, Callable[..., DataFrame]] = {
    "ga_total_users_kb_by_product": lambda hits, products: web.total_users(web.by_product(hits, products)),
    "ga_inproduct_vs_organic_by_product": lambda h, products: web.traffic_segments(h, products),
    "ga_inproduct_vs_organic_by_page": lambda h, products: web.traffic_by_page(h, products, False),
    "ga_kb_exit_rate_by_product": lambda hits, products: web.exit_rates(hits, products, ordered=False),
}


def load_web_reports(
    spark: SparkSession, hits: DataFrame, database: str, start: date, end: date, products: dict[str, web.PageTest]
) -> None:
    """All reports over the days of [start, end) that are not stored yet. Products with the same days share one scan."""
    for table, report in WEB_REPORTS.items():
        stored = sinks.ensure_table(spark, f"{database}.{table}", table)
        days = incremental.next_window(start, end, incremental.read_watermark(stored, "ga_date"))
        if days:
            sinks.append(report(web.in_days(hits, *days)), f"{database}.{table}", table)
    for table, report in PRODUCT_REPORTS.items():
        stored = sinks.ensure_table(spark, f"{database}.{table}", table)
        marks = incremental.watermark_by(stored.where(F.col("product").isin(list(products))), "product", "ga_date")
        loaded = {row["product"]: row["watermark"] for row in marks.collect()}
        windows: dict[tuple[date, date], dict[str, web.PageTest]] = {}
        for product, pages in products.items():
            days = incremental.next_window(start, end, loaded.get(product))
            if days:
                windows.setdefault(days, {})[product] = pages
        for days, due in windows.items():
            sinks.append(report(web.in_days(hits, *days), due), f"{database}.{table}", table)


def load_trends(
    spark: SparkSession,
    fetch: Callable[[date, date], tuple[DataFrame, DataFrame, Sequence[str]]],
    dictionary: DataFrame,
    queries_table: str,
    series_table: str,
    today: date,
) -> None:
    """Last week's rising queries and their series, unless that week is in already.

    `fetch` gives saved source data of [start, end): queries (region, query, value), the wide series, its queries.
    """
    sinks.ensure_table(spark, queries_table, "trend_queries")
    series = sinks.ensure_table(spark, series_table, "trend_timeseries")
    week = collection_week(today, sinks.stored_watermark(spark, queries_table, "update_date"))
    if week:
        queries, wide, names = fetch(*week)
        # the series first: the queries' date says that the week is complete
        if series.where(F.col("query_key").startswith(f"{week[1]}#")).isEmpty():
            sinks.append(trends.query_series(wide, week[1], names), series_table, "trend_timeseries")
        sinks.append(trends.rising_queries(queries, week[1], dictionary), queries_table, "trend_queries")


def load_release_calendar(spark: SparkSession, documents: DataFrame, target: str) -> None:
    """The whole calendar anew."""
    sinks.ensure_table(spark, target, "release_calendar")
    sinks.overwrite(releases.release_calendar(releases.release_rows(documents)), target, "release_calendar")


def load_store_reviews(spark: SparkSession, export: str, path: str) -> None:
    """A month's review export in place of what is stored of that month."""
    rows = readers.read_store_reviews(spark, export, schemas.TABLES["store_reviews"])
    sinks.write_months(reviews.clean_reviews(rows), path, "Review_Last_Update_Date_and_Time")


def load_mirror(
    spark: SparkSession, url: str, tables: dict[str, tuple[str, tuple[int, int], int]], properties: dict[str, str], path: str,
    staged: bool = False,
) -> None:
    """Database tables anew; each with its key, the key's bounds and the number of ranges to read it by. `staged` writes
    them as lines of JSON, for a warehouse to load."""
    for table, (key, bounds, partitions) in tables.items():
        rows = readers.read_database(spark, url, table, properties, key, bounds, partitions)
        if staged:
            sinks.write_ndjson(rows, f"{path}/{table}")
        else:
            rows.write.mode("overwrite").parquet(f"{path}/{table}")

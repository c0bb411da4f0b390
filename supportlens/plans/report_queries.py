"""Queries on web hits, surveys, releases, search trends, and the weekly measures made of them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from supportlens.functions.sentiment import sentiment_bin
from supportlens.functions.time import survey_text_to_utc
from supportlens.operators import measures, releases, rollups, sessions, survey, trends, web
from supportlens.operators.incremental import scan_submitted
from supportlens.plans.inputs import SITE, hits, listed_urls, load, with_inputs
from supportlens.sources.readers import REPORT, SURVEY_PAGE, parse_pages, word_list
from supportlens.sources.sinks import staging

WEEK_END = date(2024, 2, 5)
CLAUSES = [("REGEXP", ".*/kb/.*TOPIC-1"), ("PARTIAL", "/kb/topic-25"), ("EXACT", "/en-us/kb/topic-7")]


def _products(spark, sf):
    """Each named product with the pages it stands for."""
    return {"listed": web.listed_pages(word_list(listed_urls(spark, sf)), SITE), "named": web.any_clause(CLAUSES)}


def _product_hits(spark, sf):
    return web.by_product(hits(spark, sf), _products(spark, sf))


def _total_users(spark, sf):
    return web.total_users(hits(spark, sf))


def _kb_users(spark, sf):
    return web.kb_users(hits(spark, sf))


def _listed_users(spark, sf):
    return web.total_users(web.on_listed_pages(hits(spark, sf), listed_urls(spark, sf), SITE))


def _kb_users_products(spark, sf):
    return web.total_users(_product_hits(spark, sf))


def _countries(spark, sf):
    return web.users_by_country(hits(spark, sf, countries=True))


GAP = 240
CUTS = [datetime(2024, 1, 11), datetime(2024, 1, 12), datetime(2024, 1, 22)]


def _sessions(spark, sf):
    return sessions.sessions(hits(spark, sf))


def _sessions_by_load(spark, sf):
    """The hits in four loads, each with the sessions that the last one left open."""
    rows, parts, open_, low = hits(spark, sf), [], None, None
    for high in [*CUTS, None]:
        part = rows.where(F.lit(True) if low is None else F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
        part = part if high is None else part.where(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
        closed, open_ = sessions.load_part(part, open_, high or datetime(2100, 1, 1), GAP)
        parts, low = [*parts, closed], high
    done = parts[0]
    for part in [*parts[1:], open_]:
        done = done.unionByName(part)
    return sessions.told(done)


def _users_over(period):
    """Users by country from the stored daily rollup of two loads, the second with new users."""

    def query(spark, sf):
        rows = hits(spark, sf, countries=True)
        cut = F.lit(CUTS[0]).cast("timestamp_ntz")
        loads, codes, path = [rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut)], None, staging(spark, "rollup")
        for n, load_ in enumerate(loads):
            rollups.new_codes(load_, codes).write.mode("append").parquet(f"{path}/codes/load={n}")
            codes = spark.read.parquet(f"{path}/codes").drop("load")
            rollups.daily_users(load_, codes, ["country"]).write.parquet(f"{path}/days/load={n}")
        return rollups.users_over(spark.read.parquet(f"{path}/days"), F.to_date(F.date_trunc(period, "day")), ["country"])

    return query


def _segments_sessions(spark, sf):
    return web.traffic_segments(sessions.with_sessions(hits(spark, sf), gap=GAP))


def _segments(spark, sf):
    return web.traffic_segments(hits(spark, sf))


def _segments_products(spark, sf):
    return web.traffic_segments(hits(spark, sf), _products(spark, sf))


def _segments_pages(spark, sf):
    return web.traffic_by_page(hits(spark, sf))


def _segments_pages_products(spark, sf):
    return web.traffic_by_page(hits(spark, sf), _products(spark, sf))


def _search(spark, sf):
    return web.search_clicks(hits(spark, sf))


def _click_share(spark, sf):
    return measures.click_through(_search(spark, sf))


def _kb_exits(spark, sf):
    return web.exit_rates(hits(spark, sf))


def _kb_exits_products(spark, sf):
    return web.exit_rates(hits(spark, sf), _products(spark, sf))


def _question_exits(spark, sf):
    return web.exit_rates(hits(spark, sf), web.QUESTION_PAGES)


def _flatten(spark, sf):
    """Events as report responses of one row and two date ranges, then the flattener's way back."""
    key = F.get_json_object("props", "$.k")
    first = F.struct(F.array(F.col("event_id").cast("string"), key).alias("values"))
    second = F.struct(F.array(F.col("user_id").cast("string"), F.lit("1")).alias("values"))
    row = F.struct(
        F.array(F.date_format("ts", "yyyyMMdd"), F.col("event_type")).alias("dimensions"),
        F.array(first, second).alias("metrics"),
    )
    report = F.struct(F.struct(F.array(row).alias("rows")).alias("data"))
    json = load(spark, sf, "events", spread_by="event_id").select(F.to_json(F.struct(F.array(report).alias("reports"))).alias("value"))
    return web.flatten_report(parse_pages(json, REPORT, "reports"), ["ga_date", "ga_event"], ["id_now", "key_now", "id_before", "key_before"])


def release_documents(spark, sf):
    """Parts as release documents, one release a document."""
    record = F.struct(
        F.col("p_brand").alias("product"),
        F.col("p_type").alias("category"),
        F.col("p_partkey").alias("build_number"),
        F.date_add(F.lit(date(2020, 1, 1)), (F.col("p_partkey") % 1000).cast("int")).cast("string").alias("date"),
        F.concat((F.col("p_size") + 30).cast("string"), F.lit(".0.1")).alias("version"),
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("description"),
        F.when(F.col("p_size") > 40, F.lit(True)).alias("is_security_driven"),
    )
    name = F.concat(F.lit("r-"), F.col("p_partkey").cast("string"))
    return load(spark, sf, "part").select(
        F.to_json(F.struct(F.create_map(name, record).alias("releases"))).alias("value")
    )


def _calendar(spark, sf):
    return releases.release_calendar(releases.release_rows(release_documents(spark, sf)))


def _survey_records(spark, sf):
    """Orders as survey pages of one response, read back; a quarter has a time that does not parse."""
    text = (
        "date_format(o_orderdate + (o_orderkey * 37 % 86400) * interval '1' second, 'yyyy-MM-dd HH:mm:ss') || "
        "case o_orderkey % 4 when 0 then ' EST' when 1 then ' EDT' when 2 then ' UTC' else '' end"
    )

    def answer(value):
        return F.struct(value.alias("answer"))

    answers = F.create_map(
        F.lit("2"),
        answer(F.expr("case o_orderstatus when 'O' then 'Yes' when 'F' then 'No' end")),
        F.lit("4"),
        answer(F.col("o_orderpriority")),
    )
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.expr(text).alias("date_started"),
        F.expr(text).alias("date_submitted"),
        F.lit("Complete").alias("status"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise("").alias("contact_id"),
        F.col("o_orderstatus").alias("language"),
        F.lit("-0.5").alias("longitude"),
        answers.alias("survey_data"),
    )
    pages = load(spark, sf, "orders", spread_by="o_orderkey").select(
        F.to_json(F.struct(F.lit(1).alias("total_pages"), F.array(record).alias("data"))).alias("value")
    )
    return parse_pages(pages, SURVEY_PAGE, "data")


def _survey_rows(spark, sf):
    return survey.survey_rows(_survey_records(spark, sf)).select(
        "response_id", "time_started", "date_submitted", "status", "contact_id", "language", "longitude",
        "goal_accomplished", "rating",
    )


def _survey_export(spark, sf):
    """Responses submitted in a year, as they came."""
    timed = _survey_records(spark, sf).withColumn("at", survey_text_to_utc("date_submitted", observed=True))
    year = scan_submitted(timed, "at", datetime(1998, 1, 1), datetime(1997, 1, 1))
    return survey.export_rows(year).select("id", "date_submitted", "contact_id", "goal_accomplished", "rating")


def _survey_solved(spark, sf):
    answers = load(spark, sf, "orders").select(F.expr("nullif(o_orderstatus, 'P')").alias("goal_accomplished"))
    return survey.answer_counts(answers, "goal_accomplished", "Problem_Solved")


def _survey_scores(spark, sf):
    answers = load(spark, sf, "orders").select(F.expr("nullif(o_orderpriority, '5-LOW')").alias("rating"))
    return survey.answer_counts(answers, "rating", "Score")


def _trend_queries(spark, sf):
    part = load(spark, sf, "part")
    terms = part.select(
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("query"), F.col("p_size").alias("value")
    )
    dictionary = part.where("p_size > 20").select(
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("original_query"),
        F.upper("p_name").alias("translated_query"),
    )
    return trends.rising_queries(trends.with_regions(terms), WEEK_END, dictionary)


def _trend_series(spark, sf):
    """Hourly counts of events, one column a type, as the trend source's frames; unpivoted again."""
    events = load(spark, sf, "events")
    types = word_list(events.select("event_type").where("event_type is not null").distinct().orderBy("event_type"))
    hourly = events.select(F.expr("cast(date_trunc('hour', ts) as timestamp_ntz)").alias("date"), "event_type")
    wide = hourly.groupBy("date").pivot("event_type", types).count()
    wide = wide.select(F.lit("DE").alias("region"), "*", F.lit(False).alias("isPartial"))
    return trends.query_series(wide, WEEK_END, types)


def _weekly_sentiment(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        "l_shipdate", sentiment_bin(F.col("l_discount") * 20 - 1, F.col("l_quantity") / 10).alias("sentiment")
    )
    return measures.weekly_shares(rows, "l_shipdate", "sentiment")


def _weekly_views(spark, sf):
    return measures.weekly_change(hits(spark, sf), "ts", ["page_path"], F.lit(1))


def _weekly_satisfaction(spark, sf):
    rated = load(spark, sf, "orders").select("o_orderdate", F.col("o_orderpriority").alias("rating"))
    return measures.weekly_shares(rated, "o_orderdate", "rating")


QUERIES = {
    "sessions": _sessions,
    "sessions_by_load": _sessions_by_load,
    "ga_segment_users_sessions": _segments_sessions,
    "users_by_week": _users_over("week"),
    "users_by_month": _users_over("month"),
    "ga_total_users": _total_users,
    "ga_kb_users": _kb_users,
    "ga_listed_users": _listed_users,
    "ga_kb_users_by_product": _kb_users_products,
    "ga_users_by_country": _countries,
    "ga_segment_users": _segments,
    "ga_segment_users_by_product": _segments_products,
    "ga_segment_by_page": _segments_pages,
    "ga_segment_by_page_by_product": _segments_pages_products,
    "ga_search_ctr": _search,
    "ga_click_share": _click_share,
    "ga_kb_exit_rate": _kb_exits,
    "ga_kb_exit_rate_by_product": _kb_exits_products,
    "ga_question_exit_rate": _question_exits,
    "report_flatten": _flatten,
    "release_calendar": _calendar,
    "survey_rows": _survey_rows,
    "survey_export": _survey_export,
    "survey_histogram": _survey_solved,
    "survey_scores": _survey_scores,
    "trend_queries": _trend_queries,
    "trend_series": _trend_series,
    "weekly_sentiment": _weekly_sentiment,
    "weekly_views_change": _weekly_views,
    "weekly_satisfaction": _weekly_satisfaction,
}

_KB = "page_path ILIKE '%/kb%'"
_NAMED = "(page_path ILIKE '%/kb/%topic-1%' OR page_path ILIKE '%/kb/topic-25%' OR lower(page_path) = '/en-us/kb/topic-7')"
_LISTED = """lower(split_part(page_path, '?', 1)) IN (SELECT lower('/en-US/kb/topic-' || n_nationkey) FROM nation)"""


def _each_product(select) -> str:
    return " UNION ALL ".join(select(test, f", '{name}' AS product") for name, test in (("listed", _LISTED), ("named", _NAMED)))


def _segment_cte(tests: dict[str, str]) -> str:
    unions = " UNION ALL ".join(
        f"SELECT DISTINCT session_id, '{name}' AS ga_segment FROM hits WHERE {test}" for name, test in tests.items()
    )
    return f", members AS ({unions})"


_TRAFFIC = _segment_cte({"In-product": "lower(source) = 'inproduct'", "Organic": "lower(medium) = 'organic'"})
_SEARCH = _segment_cte(
    {"Result Clicked": "lower(event_action) = 'result clicked'", "Search": "lower(event_action) = 'search'"}
)


def _users_sql(test: str, tag: str = "") -> str:
    return f"SELECT ga_date, count(DISTINCT user_id) AS ga_users{tag} FROM hits WHERE {test} GROUP BY ga_date"


def _segments_sql(test: str, tag: str = "") -> str:
    return f"""SELECT ga_date, ga_segment, count(DISTINCT user_id) AS ga_users, count(DISTINCT session_id) AS ga_sessions{tag}
FROM hits JOIN members USING (session_id) WHERE {test} GROUP BY 1, 2"""


def _pages_sql(test: str, tag: str = "") -> str:
    return f"""SELECT ga_date, page_path AS ga_page_path, ga_segment, count(*) AS ga_pageviews,
  count(DISTINCT user_id) AS ga_users, count(DISTINCT session_id) AS ga_sessions{tag}
FROM hits JOIN members USING (session_id) WHERE {test} GROUP BY 1, 2, 3"""


def _exits_sql(test: str, tag: str = "") -> str:
    return f"""SELECT ga_date, page_path AS ga_exitPagePath, sum(is_exit) / count(*) * 100 AS ga_exitRate,
  CAST(sum(is_exit) AS BIGINT) AS ga_exits, count(*) AS ga_pageviews{tag}
FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY session_id ORDER BY ts DESC, hit_id DESC) = 1 THEN 1 ELSE 0 END
  AS is_exit FROM hits) WHERE {test} GROUP BY 1, 2"""


_CTR = f"""{_SEARCH}, ctr AS (SELECT ga_date, ga_segment, count(DISTINCT user_id) AS ga_users,
  count(DISTINCT (session_id, event_action)) AS ga_uniqueEvents FROM hits JOIN members USING (session_id) GROUP BY 1, 2)
"""


def _shares_sql(source: str, day: str, category: str) -> str:
    return f"""SELECT week, {category}, n, n / sum(n) OVER (PARTITION BY week) AS share FROM (
  SELECT CAST(date_trunc('week', {day}) AS DATE) AS week, {category}, count(*) AS n FROM {source} GROUP BY 1, 2)"""


def _sessions_sql(gap: int) -> str:
    return f"""
, begun AS (SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL {gap} MINUTE, true) AS begins FROM hits WINDOW w AS (PARTITION BY user_id ORDER BY ts, hit_id)),
of_session AS (SELECT * EXCLUDE (session_id), max(CASE WHEN begins THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, hit_id) AS started FROM begun)
"""


_SESSION_ROWS = """SELECT user_id, started, max(ts) AS ended, count(*) AS hits, arg_min(page_path, (ts, hit_id)) AS first_page,
  arg_max(page_path, (ts, hit_id)) AS last_page FROM of_session GROUP BY 1, 2"""

ORACLE = {
    "sessions": with_inputs("hits", _sessions_sql(30) + _SESSION_ROWS),
    "sessions_by_load": with_inputs("hits", _sessions_sql(GAP) + _SESSION_ROWS),
    **{f"users_by_{period}": with_inputs("hits", f"""SELECT CAST(date_trunc('{period}', ts) AS DATE) AS period, country,
  count(DISTINCT user_id) AS users, CAST(count(*) AS BIGINT) AS hits FROM hits GROUP BY 1, 2""") for period in ("week", "month")},
    "ga_segment_users_sessions": with_inputs("hits", _sessions_sql(GAP) + """
, marked AS (SELECT *, user_id || '#' || started AS session_id FROM of_session),
said AS (SELECT ga_date, session_id, unnest(list_filter([CASE WHEN bool_or(source = 'InProduct') THEN 'In-product' END,
    CASE WHEN bool_or(medium = 'organic') THEN 'Organic' END], lambda x: x IS NOT NULL)) AS ga_segment FROM marked GROUP BY 1, 2)
SELECT ga_date, ga_segment, count(DISTINCT user_id) AS ga_users, count(DISTINCT session_id) AS ga_sessions
FROM marked JOIN said USING (ga_date, session_id) GROUP BY 1, 2"""),
    "ga_total_users": with_inputs("hits", _users_sql("true")),
    "ga_kb_users": with_inputs("hits", _users_sql(_KB)),
    "ga_listed_users": with_inputs("hits", _users_sql(_LISTED)),
    "ga_kb_users_by_product": with_inputs("hits", _each_product(_users_sql)),
    "ga_users_by_country": with_inputs("hits", """SELECT ga_date, country AS ga_country,
  count(DISTINCT user_id) AS ga_users FROM hits GROUP BY 1, 2"""),
    "ga_segment_users": with_inputs("hits", _TRAFFIC + _segments_sql("true")),
    "ga_segment_users_by_product": with_inputs("hits", _TRAFFIC + _each_product(_segments_sql)),
    "ga_segment_by_page": with_inputs("hits", _TRAFFIC + _pages_sql("true")),
    "ga_segment_by_page_by_product": with_inputs("hits", _TRAFFIC + _each_product(_pages_sql)),
    "ga_search_ctr": with_inputs("hits", _CTR + "SELECT * FROM ctr"),
    "ga_click_share": with_inputs("hits", _CTR + """SELECT ga_date,
  sum(ga_users) FILTER (ga_segment = 'Result Clicked') / sum(ga_users) FILTER (ga_segment = 'Search') AS click_share
FROM ctr GROUP BY 1"""),
    "ga_kb_exit_rate": with_inputs("hits", _exits_sql(_KB)),
    "ga_kb_exit_rate_by_product": with_inputs("hits", _each_product(_exits_sql)),
    "ga_question_exit_rate": with_inputs("hits", _exits_sql("page_path ILIKE '%/questions/%'")),
    "report_flatten": """SELECT strftime(ts, '%Y%m%d') AS ga_date, event_type AS ga_event,
  CAST(event_id AS VARCHAR) AS id_now, json_extract_string(props, '$.k') AS key_now,
  CAST(user_id AS VARCHAR) AS id_before, '1' AS key_before FROM events""",
    "release_calendar": """SELECT 'r-' || p_partkey AS release, p_brand AS product, p_type AS category,
  p_partkey AS build_number, DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS release_date,
  (p_size + 30) || '.0.1' AS version, CASE WHEN p_size > 25 THEN p_name ELSE '' END AS description,
  p_size > 40 AS is_security_driven, DATE '2020-01-01' + CAST(p_partkey % 1000 + k AS INTEGER) AS date_utc,
  k + 1 AS day_num, CAST(floor(k / 7) AS BIGINT) + 1 AS week_num
FROM part, (SELECT unnest(range(-28, 56)) AS k) WHERE p_size + 30 >= 57""",
    "survey_rows": """SELECT o_orderkey AS response_id, utc AS time_started, utc AS date_submitted, 'Complete' AS status,
  CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS contact_id, o_orderstatus AS language, CAST(-0.5 AS DOUBLE) AS longitude,
  CASE o_orderstatus WHEN 'O' THEN 'Yes' WHEN 'F' THEN 'No' ELSE '' END AS goal_accomplished, o_orderpriority AS rating
FROM (SELECT *, o_orderdate + to_seconds(o_orderkey * 37 % 86400)
    + to_hours(CASE o_orderkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 4 ELSE 0 END) AS utc FROM orders)
WHERE o_orderkey % 4 < 3""",
    "survey_export": """SELECT CAST(o_orderkey AS VARCHAR) AS id,
  strftime(wall, '%Y-%m-%d %H:%M:%S') || CASE o_orderkey % 4 WHEN 0 THEN ' EST' WHEN 1 THEN ' EDT' ELSE ' UTC' END
    AS date_submitted,
  CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS contact_id,
  CASE o_orderstatus WHEN 'O' THEN 'Yes' WHEN 'F' THEN 'No' ELSE '' END AS goal_accomplished, o_orderpriority AS rating
FROM (SELECT *, o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS wall FROM orders)
WHERE o_orderkey % 4 < 3 AND wall >= TIMESTAMP '1997-01-01' AND wall < TIMESTAMP '1998-01-01'""",
    "survey_histogram": """SELECT nullif(o_orderstatus, 'P') AS Problem_Solved, count(nullif(o_orderstatus, 'P')) AS count
FROM orders GROUP BY 1""",
    "survey_scores": """SELECT nullif(o_orderpriority, '5-LOW') AS Score, count(nullif(o_orderpriority, '5-LOW')) AS count
FROM orders GROUP BY 1""",
    "trend_queries": """SELECT DATE '2024-02-05' AS update_date, region, query AS original_query,
  CASE WHEN p_size > 20 THEN upper(p_name) ELSE query END AS translated_query,
  '2024-02-05#' || region || '#' || query AS query_key_ts, CAST(p_size AS BIGINT) AS search_increase_pct
FROM (SELECT *, p_name || ' ' || p_partkey AS query FROM part),
  (SELECT unnest(['', 'US', 'DE', 'IN', 'FR', 'RU', 'IT', 'BR', 'PL', 'CN', 'NL', 'JP', 'ES', 'ID']) AS region)""",
    "trend_series": """SELECT '2024-02-05#DE#' || event_type AS query_key, date_trunc('hour', ts) AS timestamp,
  event_type AS original_query, count(*) AS relative_search_volume FROM events GROUP BY ALL""",
    "weekly_sentiment": _shares_sql(
        """(SELECT l_shipdate, CASE WHEN magnitude < 0.5 THEN 'neutral' WHEN score < -0.2 THEN 'negativ'
  WHEN score <= 0.2 THEN 'neutral' ELSE 'positive' END AS sentiment
FROM (SELECT *, l_discount * 20 - 1 AS score, l_quantity / 10 AS magnitude FROM lineitem))""",
        "l_shipdate",
        "sentiment",
    ),
    "weekly_views_change": with_inputs("hits", """
, weeks AS (SELECT page_path, CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS total FROM hits GROUP BY 1, 2)
SELECT w.page_path, w.week, w.total, (w.total - b.total) / b.total * 100 AS change_pct
FROM weeks w LEFT JOIN weeks b ON w.page_path = b.page_path AND b.week = w.week - 7"""),
    "weekly_satisfaction": _shares_sql("(SELECT *, o_orderpriority AS rating FROM orders)", "o_orderdate", "rating"),
}

"""Web reports on a handful of hits."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from supportlens import schemas
from supportlens.operators import web
from supportlens.sources.readers import REPORT, parse_pages
from test_operators import frame, tuples

HIT = (
    "hit_id long, ts ntz, user_id long, session_id string, page_path string, country string, source string, "
    "medium string, event_action string"
)
KB, ASK = "/en-US/kb/a", "/en-US/questions/1"
ROWS = [
    (1, "2020-01-01 10:00:00", 1, "s1", KB, "DE", "inproduct", "none", ""),
    (2, "2020-01-01 10:01:00", 1, "s1", KB + "?x=1", "DE", "web", "none", "Search"),
    (3, "2020-01-01 10:02:00", 1, "s1", ASK, "DE", "web", "organic", "Result Clicked"),
    (4, "2020-01-01 11:00:00", 2, "s2", KB, "US", "web", "organic", "Search"),
    (5, "2020-01-01 23:59:00", 3, "s3", KB, "US", "web", "none", ""),
    (6, "2020-01-02 00:01:00", 3, "s3", ASK, "US", "web", "none", ""),
    (7, "2020-01-02 09:00:00", 1, "s4", KB, "DE", "Inproduct", "none", "Search"),
    (8, "2020-01-02 09:00:00", 1, None, ASK, "DE", "web", "organic", ""),
]
D1, D2 = date(2020, 1, 1), date(2020, 1, 2)


@pytest.fixture(scope="module")
def hits(spark):
    return frame(spark, ROWS, HIT)


def test_users(hits):
    assert tuples(web.total_users(hits), "ga_date", "ga_users") == [(D1, 3), (D2, 2)]
    assert tuples(web.kb_users(hits), "ga_date", "ga_users") == [(D1, 3), (D2, 1)]
    assert tuples(web.users_by_country(hits), "ga_country", "ga_date", "ga_users") == [
        ("DE", D1, 1), ("DE", D2, 1), ("US", D1, 2), ("US", D2, 1),
    ]
    assert web.in_days(hits, D1, D2).count() == 5
    tagged = web.total_users(web.by_product(hits, {"p": web.KB_PAGES, "q": web.QUESTION_PAGES, "none": web.listed_pages([])}))
    assert set(tagged.columns) == set(schemas.TABLES["ga_total_users_kb_by_product"].names)
    assert tuples(tagged, "product", "ga_date", "ga_users") == [("p", D1, 3), ("p", D2, 1), ("q", D1, 1), ("q", D2, 2)]


def test_segments(hits):
    """Session s1 is in both segments; membership comes from hits the page filter hides."""
    report = web.traffic_segments(hits)
    assert tuples(report, "ga_date", "ga_segment", "ga_users", "ga_sessions") == [
        (D1, "In-product", 1, 1), (D1, "Organic", 2, 2), (D2, "In-product", 1, 1),
    ]
    asked = web.traffic_segments(hits, web.QUESTION_PAGES)
    assert tuples(asked, "ga_segment", "ga_sessions") == [("In-product", 1), ("Organic", 1)]
    pages = web.traffic_by_page(hits, {"p": web.KB_PAGES})
    assert set(pages.columns) == set(schemas.TABLES["ga_inproduct_vs_organic_by_page"].names)
    assert tuples(pages.where(F.col("ga_date") == D1), "ga_page_path", "ga_segment", "ga_pageviews") == [
        (KB, "In-product", 1), (KB, "Organic", 2), (KB + "?x=1", "In-product", 1), (KB + "?x=1", "Organic", 1),
    ]
    views = [r["ga_pageviews"] for r in pages.collect()]
    assert views == sorted(views, reverse=True)


def test_search(hits):
    assert tuples(web.search_clicks(hits), "ga_date", "ga_segment", "ga_users", "ga_uniqueEvents") == [
        (D1, "Result Clicked", 1, 3), (D1, "Search", 2, 4), (D2, "Search", 1, 1),
    ]


def test_exits(hits):
    kb = {(r["ga_date"], r["ga_exitPagePath"]): (r["ga_exits"], r["ga_pageviews"], r["ga_exitRate"]) for r in web.exit_rates(hits).collect()}
    assert kb[D1, KB] == (2, 3, pytest.approx(200 / 3)) and kb[D1, KB + "?x=1"] == (0, 1, 0.0)
    assert kb[D2, KB] == (1, 1, 100.0) and len(kb) == 3
    asked = web.exit_rates(hits, web.QUESTION_PAGES)
    assert tuples(asked, "ga_date", "ga_exits", "ga_pageviews") == [(D1, 1, 1), (D2, 1, 2)]
    assert asked.columns == schemas.TABLES["ga_questions_exit_rate"].names


def test_page_filters(spark):
    site = "https://help.example.org"
    pages = spark.createDataFrame(
        [(p,) for p in ("/en-US/kb/a", "/en-us/KB/A?x=?y", "/en-US/kb/ab", "/x/en-US/kb/a", "/b", "", None)], "p string"
    )
    urls = [site + "/en-US/kb/a  ", "/b", "/b", ""]
    frame_of_urls = spark.createDataFrame([(u,) for u in urls], "value string")
    clauses = web.url_clauses(urls[:2], site)
    assert clauses == [("REGEXP", r"^/en-US/kb/a(\?.*)?$"), ("REGEXP", r"^/b(\?.*)?$")]
    any_case = [("/b",), ("/en-US/kb/a",), ("/en-us/KB/A?x=?y",)]
    for ignore_case, wanted in ((True, any_case), (False, any_case[:2])):
        for test in (web.listed_pages(urls, site, ignore_case), web.any_clause(clauses, ignore_case)):
            assert tuples(web.on_pages(pages, test, "p"), "p") == wanted
        hits = pages.withColumnRenamed("p", "page_path")
        assert tuples(web.on_listed_pages(hits, frame_of_urls, site, ignore_case), "page_path") == wanted


def test_preview_pages(spark):
    kept = ["/en-US/kb/about-acme-preview-x", "/de/kb/acme-sync-troubleshooting-and-tips", "/kb/send-usage-data-acme-mobile-browsers"]
    pages = spark.createDataFrame([(p,) for p in [*kept, "/acme-preview", "/kb/acme"]], "p string")
    assert tuples(web.on_pages(pages, web.preview_pages("acme"), "p"), "p") == sorted((p,) for p in kept)
    with pytest.raises(ValueError, match="unknown operator"):
        web.clause(F.col("p"), "NEAR", "x")


def test_flatten(spark):
    rows = {"rows": [{"dimensions": ["d1", "d2"], "metrics": [{"values": ["v1", "v2"]}, {"values": ["w1"]}]}]}
    pages = spark.createDataFrame([(json.dumps({"reports": [{"data": rows}, {"data": {}}]}),)], "value string")
    flat = web.flatten_report(parse_pages(pages, REPORT, "reports"), ["a", "b"], ["x", "y", "z", "none"])
    assert [tuple(r) for r in flat.collect()] == [("d1", "d2", "v1", "v2", "w1", None)]

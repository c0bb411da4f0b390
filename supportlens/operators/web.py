"""Web-analytics reports over a table of hits.

A session ends with its day, so a day's report is the same whether it is made alone or with others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supportlens.functions.text import strip_prefix
from supportlens.operators.incremental import within

# Which pages count: a condition on a path column.
PageTest = Callable[[Column], Column]
# One clause of such a condition: operator and expression.
Clause = tuple[str, str]


def _day() -> Column:
    return F.to_date("ts").alias("ga_date")


def clause(value: Column, operator: str, expression: str, ignore_case: bool = True) -> Column:
    """REGEXP finds anywhere, PARTIAL contains, EXACT equals; the analytics API ignores case by default."""
    if operator == "REGEXP":
        return value.rlike(("(?iU)" if ignore_case else "(?U)") + expression)
    if ignore_case:
        value, expression = F.lower(value), expression.lower()
    if operator == "PARTIAL":
        return F.contains(value, F.lit(expression))
    if operator == "EXACT":
        return value == expression
    raise ValueError(f"unknown operator {operator!r}")


def any_clause(clauses: Sequence[Clause], ignore_case: bool = True) -> PageTest:
    """Pages that meet one clause or more."""
    distinct = list(dict.fromkeys(clauses))
    return lambda path: reduce(or_, [clause(path, *c, ignore_case) for c in distinct])


def _bare(path: Column, ignore_case: bool) -> Column:
    """A path without its query part."""
    bare = F.regexp_replace(path, r"(?s)\?.*$", "")
    return F.lower(bare) if ignore_case else bare


def listed_pages(urls: Sequence[str], site: str = "", ignore_case: bool = True) -> PageTest:
    """Pages that are, without their query part, one of the listed URLs: one look-up in place of a pattern a URL."""
    paths = [url.rstrip().removeprefix(site) for url in urls]
    wanted = [p.lower() if ignore_case else p for p in paths if p]
    return lambda path: _bare(path, ignore_case).isin(wanted)


def on_listed_pages(hits: DataFrame, urls: DataFrame, site: str = "", ignore_case: bool = True) -> DataFrame:
    """Hits on listed URLs (column `value`), for lists too long to be part of a plan."""
    listed = strip_prefix(F.rtrim("value"), site)
    wanted = urls.select((F.lower(listed) if ignore_case else listed).alias("_page")).where("_page <> ''")
    bare = hits.withColumn("_page", _bare(F.col("page_path"), ignore_case))
    return bare.join(wanted, "_page", "left_semi").select(*hits.columns)


def url_clauses(urls: Sequence[str], site: str = "") -> list[Clause]:
    """The same list as patterns, one a URL, for lists that hold patterns themselves."""
    return [("REGEXP", "^" + url.rstrip().removeprefix(site) + r"(\?.*)?$") for url in urls]


def preview_pages(brand: str) -> PageTest:
    """The mobile preview product's pages."""
    return any_clause(
        [
            ("REGEXP", f".*/kb/.*{brand}-preview.*"),
            ("PARTIAL", f"/kb/{brand}-sync-troubleshooting-and-tips"),
            ("PARTIAL", f"/kb/send-usage-data-{brand}-mobile-browsers"),
        ]
    )


KB_PAGES = any_clause([("PARTIAL", "/kb")])
QUESTION_PAGES = any_clause([("PARTIAL", "/questions/")])

TRAFFIC_SEGMENTS = {"In-product": ("source", "inproduct"), "Organic": ("medium", "organic")}
SEARCH_SEGMENTS = {"Result Clicked": ("event_action", "Result Clicked"), "Search": ("event_action", "Search")}


def on_pages(df: DataFrame, pages: PageTest, path: str = "page_path") -> DataFrame:
    return df.where(pages(F.col(path)))


def by_product(df: DataFrame, products: Mapping[str, PageTest], path: str = "page_path") -> DataFrame:
    """Rows of each product's pages, once a product, with its name in `product`. Reports group by that column where
    they find it, so one scan makes a report of all products."""
    names = F.array(*[F.when(pages(F.col(path)), F.lit(name)) for name, pages in products.items()])
    return df.withColumn("product", F.explode(F.array_compact(names)))


def _product(df: DataFrame) -> list[str]:
    return ["product"] if "product" in df.columns else []


def in_days(hits: DataFrame, start: date, end: date) -> DataFrame:
    """Hits of [start, end)."""
    return within(hits, "ts", start, end, "[)")


def total_users(seen: DataFrame) -> DataFrame:
    """Users a day, of the given hits (all, or those on_pages or by_product)."""
    return seen.groupBy(_day(), *_product(seen)).agg(F.count_distinct("user_id").alias("ga_users"))


def kb_users(hits: DataFrame) -> DataFrame:
    return total_users(on_pages(hits, KB_PAGES))


def users_by_country(hits: DataFrame) -> DataFrame:
    return hits.groupBy(_day(), F.col("country").alias("ga_country")).agg(F.count_distinct("user_id").alias("ga_users"))


def _segmented(hits: DataFrame, segments: dict[str, tuple[str, str]], keys: Sequence[Column | str]) -> DataFrame:
    """Rows of the keys beside day and session, with `_views`, once for each segment that the session has a hit in.

    One pass over the hits: they are summed by the keys with the segments' flags, and the flags of a session's rows are
    brought together on these sums. Membership is so decided over all of a session's hits, before any page filter.
    """
    flags = [F.max(clause(F.col(column), "EXACT", value)).alias(f"_s{i}") for i, (column, value) in enumerate(segments.values())]
    sums = hits.where("session_id is not null").groupBy(_day(), "session_id", *keys).agg(*flags, F.count("*").alias("_views"))
    session = Window.partitionBy("ga_date", "session_id")
    names = [F.when(F.max(f"_s{i}").over(session), F.lit(name)) for i, name in enumerate(segments)]
    named = sums.withColumn("_segments", F.array_compact(F.array(*names)))
    return named.withColumn("ga_segment", F.explode("_segments")).drop("_segments", *[f"_s{i}" for i in range(len(segments))])


def _counting(rows: DataFrame, pages: PageTest | Mapping[str, PageTest] | None, path: str) -> DataFrame:
    """Rows of the pages that count: all, those of one test, or those of each product."""
    if pages is None:
        return rows
    return by_product(rows, pages, path) if isinstance(pages, Mapping) else on_pages(rows, pages, path)


def traffic_segments(hits: DataFrame, pages: PageTest | Mapping[str, PageTest] | None = None) -> DataFrame:
    """Users and sessions a day, in-product against organic; of the hits on some pages, if only those count."""
    rows = _segmented(hits, TRAFFIC_SEGMENTS, ["user_id"] if pages is None else ["user_id", "page_path"])
    counted = _counting(rows, pages, "page_path")
    return counted.groupBy("ga_date", "ga_segment", *_product(counted)).agg(
        F.count_distinct("user_id").alias("ga_users"), F.count_distinct("session_id").alias("ga_sessions")
    )


def traffic_by_page(
    hits: DataFrame, pages: PageTest | Mapping[str, PageTest] | None = None, ordered: bool = True
) -> DataFrame:
    """The same a page, most viewed first."""
    rows = _segmented(hits, TRAFFIC_SEGMENTS, ["user_id", F.col("page_path").alias("ga_page_path")])
    counted = _counting(rows, pages, "ga_page_path")
    report = counted.groupBy("ga_date", "ga_page_path", "ga_segment", *_product(counted)).agg(
        F.sum("_views").alias("ga_pageviews"),
        F.count_distinct("user_id").alias("ga_users"),
        F.count_distinct("session_id").alias("ga_sessions"),
    )
    return report.orderBy(F.desc("ga_pageviews")) if ordered else report


def search_clicks(hits: DataFrame) -> DataFrame:
    """Users and unique events (session and action) a day, of sessions that searched or clicked a result."""
    return _segmented(hits, SEARCH_SEGMENTS, ["user_id", "event_action"]).groupBy("ga_date", "ga_segment").agg(
        F.count_distinct("user_id").alias("ga_users"),
        F.count_distinct("session_id", "event_action").alias("ga_uniqueEvents"),
    )


def exit_rates(
    hits: DataFrame, pages: PageTest | Mapping[str, PageTest] = KB_PAGES, ordered: bool = True
) -> DataFrame:
    """Views, exits (sessions that end there) and their ratio in percent, a day and page; most viewed first. Pages may
    be given by product.

    One pass over the hits: views and the last hit of each session and page, its time and id in one number, which a
    hash aggregate holds. From these rows come the page a session ends on and the sums by page. Hits without a session
    are views, but end nothing.
    """
    moment = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(19,0)") * F.lit(Decimal(10**19)).cast("decimal(20,0)")
    last = (moment + F.coalesce("hit_id", F.lit(0)).cast("decimal(19,0)")).cast("decimal(38,0)")
    path = "ga_exitPagePath"
    seen = hits.select(_day(), F.col("page_path").alias(path), "session_id", last.alias("_last"))
    visits = seen.groupBy("ga_date", "session_id", path).agg(F.count("*").alias("_views"), F.max("_last").alias("_last"))
    # pages without a session have keys of their own, so that they don't meet in one task
    session = Window.partitionBy("ga_date", "session_id", F.when(F.col("session_id").isNull(), F.col(path)))
    ends = F.col("session_id").isNotNull() & (F.col("_last") == F.max("_last").over(session))
    totals = visits.withColumn("_ends", F.coalesce(ends, F.lit(False)).cast("long")).groupBy("ga_date", path)
    kept = _counting(totals.agg(F.sum("_ends").alias("ga_exits"), F.sum("_views").alias("ga_pageviews")), pages, path)
    report = kept.select(
        "ga_date",
        path,
        (F.col("ga_exits") / F.col("ga_pageviews") * 100).alias("ga_exitRate"),
        "ga_exits",
        "ga_pageviews",
        *_product(kept),
    )
    return report.orderBy(F.desc("ga_pageviews")) if ordered else report


def flatten_report(reports: DataFrame, dimensions: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Nested reports to one row each of their rows: dimension values, then the metric values of all date ranges."""
    rows = reports.select(F.explode("data.rows").alias("row"))
    values = F.flatten(F.transform("row.metrics", lambda m: m["values"]))
    flat = rows.select(F.col("row.dimensions").alias("_d"), values.alias("_m"))
    return flat.select(
        *[F.get("_d", F.lit(i)).alias(name) for i, name in enumerate(dimensions)],
        *[F.get("_m", F.lit(i)).alias(name) for i, name in enumerate(metrics)],
    )

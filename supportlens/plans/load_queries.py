"""Queries on loads: casts, times, watermarks, scans, table changes, the database mirror."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from supportlens.functions import time as tm
from supportlens.functions.cast import safe_cast
from supportlens.operators import incremental, ledger, mirror, phrases, tables
from supportlens.plans.inputs import at, documents, load, tweets, with_inputs


def _dirty(spark, sf):
    """Events with a value column in all the shapes a source sends."""
    return load(spark, sf, "events").select(
        "event_id",
        F.expr(
            "case event_type when 'view' then cast(user_id as string) when 'click' then ' ' || user_id || ' ' "
            "when 'signup' then user_id || '.5' when 'error' then 'pickles' end"
        ).alias("raw"),
        (F.col("event_id") % 3 == 0).alias("flag"),
    )


def _safe_cast(spark, sf):
    rows = _dirty(spark, sf)
    return rows.select(
        "event_id",
        safe_cast(rows, "raw", "int").alias("int_value"),
        safe_cast(rows, "raw", "str", compat=True).alias("text_compat"),
        safe_cast(rows, "raw", "bool", compat=True).alias("flag_compat"),
        safe_cast(rows, "flag", "int").alias("flag_int"),
    )


def _order_times(spark, sf):
    wall = F.expr("o_orderdate + (o_orderkey * 37 % 86400) * interval '1' second")
    return load(spark, sf, "orders").select("o_orderkey", wall.alias("wall"))


def _pacific(spark, sf):
    return _order_times(spark, sf).select("o_orderkey", tm.to_utc("wall").alias("utc"))


def _pacific_day(spark, sf):
    return _order_times(spark, sf).select("o_orderkey", tm.from_utc("wall").cast("date").alias("day"))


def _survey_time(spark, sf):
    text = (
        "date_format(wall, 'yyyy-MM-dd HH:mm:ss') || case o_orderkey % 4 when 0 then ' EST' when 1 then ' EDT' "
        "when 2 then ' UTC' else '' end"
    )
    rows = _order_times(spark, sf).withColumn("text", F.expr(text))
    return rows.select(
        "o_orderkey",
        tm.survey_text_to_utc("text").alias("utc"),
        tm.survey_text_to_utc("text", observed=True).alias("stored"),
        tm.survey_watermark_text("wall").alias("watermark"),
    )


def _compact(spark, sf):
    text = F.when(F.col("o_orderkey") % 7 == 0, "20201399").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return load(spark, sf, "orders").select("o_orderkey", tm.compact_date(text).alias("day"))


def _bounds(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return load(spark, sf, "orders").select(
        "o_orderkey",
        tm.week_start(day).alias("week"),
        tm.month_first(day).alias("month_first"),
        tm.month_last(day).alias("month_last"),
        tm.settled(day, date(2000, 1, 1)).alias("settled"),
    )


def _scan(spark, sf):
    return incremental.scan_range(load(spark, sf, "events"), "ts", "2024-01-05 10:00:00", "2024-01-20 00:00:00")


def _scan_limit(spark, sf):
    rows = incremental.scan_range(load(spark, sf, "events"), "ts", "2024-01-05 10:00:00", "2024-01-20 00:00:00", 500)
    return rows.select("event_id", "ts")


def _days(spark, sf):
    slices = incremental.scan_days(load(spark, sf, "events"), "ts", date(2024, 1, 3), date(2024, 1, 9), ["event_type"])
    return slices.groupBy("day", "event_type").agg(F.count("*").alias("n"))


def _watermark(spark, sf):
    return incremental.watermark(load(spark, sf, "events"), "ts", "2010-05-01")


def _watermark_by(spark, sf):
    return incremental.watermark_by(load(spark, sf, "events"), "event_type", "ts")


def _id_range(spark, sf):
    return incremental.id_range(tweets(spark, sf), "id_str")


def _since(spark, sf):
    return incremental.since(tweets(spark, sf), "id_str", 100).select("id_str", "created_at")


def _source_day(spark, sf):
    return incremental.source_day(load(spark, sf, "events"), "ts")


def _new(spark, sf):
    docs = load(spark, sf, "documents").drop("text")
    return incremental.new_rows(docs, load(spark, sf, "labels"), ["doc_id"])


def _month(spark, sf):
    """The last month of the orders arrives again with other amounts."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    last = orders.agg(F.trunc(F.max("o_orderdate").cast("date"), "MM")).scalar()
    batch = orders.where(F.col("o_orderdate") >= last).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return incremental.replace_months(orders, batch, "o_orderdate")


def _rules_changed(spark, sf):
    part = load(spark, sf, "part")
    old = part.select(F.col("p_type").alias("topic"), F.col("p_name").alias("keywords"))
    new = part.select(F.col("p_type").alias("topic"), F.regexp_replace("p_name", "^red ", "dark red ").alias("keywords"))
    return tables.difference(new, old, ["topic", "keywords"])


def _chunks(spark, sf):
    votes = load(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderdate, timestamp_ntz'1996-02-02')").alias("created"))
    return mirror.range_chunks(votes, "created", ["1996-12-31", "1999-12-31"])


def _balanced(spark, sf):
    """Orders with times that crowd at the beginning, and some without, cut into sixteen ranges: facts on the ranges."""
    crowded = at("cast(pow(o_orderkey % 9973, 3) as bigint) div 1000 + o_orderkey % 7")
    rows = load(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 50 > 0, crowded).alias("created"))
    _, cuts = mirror.balanced_cuts(rows, "created", 16)
    timed = F.col("least").isNotNull()
    ranges = mirror.range_chunks(rows, "created", cuts).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("created").alias("least"), F.max("created").alias("greatest")
    )
    before = F.lag("greatest").over(Window.orderBy("chunk"))  # a row a range
    facts = ranges.withColumn("apart", F.coalesce(F.col("least") > before, F.lit(True)))
    return facts.agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(~timed, F.col("n"))).alias("n_untimed"),
        F.count_if(timed).alias("n_ranges"),
        F.min("apart").alias("disjoint"),
        (F.max(F.when(timed, F.col("n"))) <= 1.2 * F.avg(F.when(timed, F.col("n")))).alias("balanced"),
    )


def _phrases(spark, sf):
    """Part names with their type and number, translated by phrases of one to three words that overlap."""
    part = load(spark, sf, "part")
    second, kind, number = F.substring_index("p_name", " ", -1), F.lower("p_type"), F.col("p_partkey").cast("string")
    rules = F.array(
        F.when(F.col("p_size") > 20, F.col("p_name")),
        F.when(F.col("p_size") % 3 == 0, F.concat_ws(" ", second, kind)),
        F.when(F.col("p_partkey") % 2 == 1, F.concat_ws(" ", kind, number)),
        F.when(F.col("p_size") > 48, second),
        F.when(F.col("p_size") == 7, F.concat_ws(" ", "p_name", kind)),
    )
    known = part.select("p_size", F.explode(F.array_compact(rules)).alias("original_query"))
    known = known.select("original_query", F.concat(F.upper(F.translate("original_query", " ", "_")), F.lit("#"), F.col("p_size")).alias("translated_query"))
    return phrases.translate_phrases(part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type", number).alias("original_query")), known)


def _votes(spark, sf):
    """Line items vote on orders, which revise customers' pages."""
    votes = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("revision_id"), F.col("l_shipdate").alias("created"), F.col("l_linenumber").alias("helpful")
    )
    revisions = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("document_id"))
    documents = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("locale")
    )
    return mirror.votes_by_document(votes, revisions, documents, "1998-12-31")


def _post(spark, sf):
    return documents(spark, sf).select(
        F.col("doc_id").cast("string"),
        F.when(F.col("doc_id") % 5 == 0, "none").otherwise(F.col("doc_id").cast("string")),
        F.replace("text", F.lit(". "), F.lit(".\r\n")),
        F.col("n_chars"),
        F.expr("timestamp_ntz'2020-10-20 00:00:00' + doc_id * interval '40009' second"),
        F.when(F.col("doc_id") % 7 == 0, "never").otherwise(F.lit("2020-03-08 02:30:00")),
        F.lit(None).cast("string"),
    )


def _conform(spark, sf):
    return mirror.conform(_post(spark, sf), "forums_post")


def _conform_compat(spark, sf):
    thread = load(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")),
        F.col("o_custkey"),
        F.col("o_orderdate"),
        F.col("o_totalprice"),
        F.col("o_custkey"),
        F.lit("5.0"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")),
        (F.col("o_orderkey") % 2).cast("int"),
    )
    return mirror.conform(thread, "forums_thread", compat=True)


def _ranges(spark, sf):
    """Ranges of days by customer: from each order on, for up to 60 days, some of them empty."""
    low = F.to_date("o_orderdate")
    return load(spark, sf, "orders").select("o_custkey", low.alias("low"), F.date_add(low, (F.col("o_orderkey") % 61).cast("int")).alias("high"))


def _merged_ranges(spark, sf):
    return ledger.merged_ranges(_ranges(spark, sf), ["o_custkey"])


def _missing_ranges(spark, sf):
    return ledger.missing_ranges(_ranges(spark, sf), ["o_custkey"])


PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
def _bucket():
    return (F.col("p_partkey") % 64).alias("bucket")


def _part_fingerprints(spark, sf):
    return tables.fingerprints(load(spark, sf, "part"), PART_COLUMNS, [_bucket()])


def _part_changes(spark, sf):
    """Buckets that differ once some parts have another size, two are repeated and a bucket is gone."""
    parts = load(spark, sf, "part").select(*PART_COLUMNS)
    size = F.when(F.col("p_partkey") % 64 == 9, F.col("p_size") + 1).otherwise(F.col("p_size"))
    later = parts.withColumn("p_size", size).where(F.col("p_partkey") % 64 != 20).unionAll(parts.where("p_partkey in (3, 70)"))
    sides = [tables.fingerprints(side, PART_COLUMNS, [_bucket()]) for side in (parts, later)]
    return tables.changed_parts(*sides)


QUERIES = {
    "loaded_ranges": _merged_ranges,
    "missing_ranges": _missing_ranges,
    "part_fingerprints": _part_fingerprints,
    "part_changes": _part_changes,
    "safe_cast": _safe_cast,
    "pacific_to_utc": _pacific,
    "utc_to_pacific_day": _pacific_day,
    "survey_to_utc": _survey_time,
    "compact_dates": _compact,
    "calendar_bounds": _bounds,
    "incremental_scan": _scan,
    "incremental_scan_limit": _scan_limit,
    "day_slices": _days,
    "watermark": _watermark,
    "watermark_by_product": _watermark_by,
    "watermark_source_day": _source_day,
    "id_range": _id_range,
    "since_id": _since,
    "append_dedup": _new,
    "month_overwrite": _month,
    "rules_changed": _rules_changed,
    "vote_chunks": _chunks,
    "balanced_ranges": _balanced,
    "translated_phrases": _phrases,
    "kb_votes_join": _votes,
    "conform_table": _conform,
    "conform_compat": _conform_compat,
}

_RAW = """raw_events AS (SELECT event_id, event_id % 3 = 0 AS flag,
  CASE event_type WHEN 'view' THEN CAST(user_id AS VARCHAR) WHEN 'click' THEN ' ' || user_id || ' '
    WHEN 'signup' THEN user_id || '.5' WHEN 'error' THEN 'pickles' END AS raw FROM events)"""
_WALL = "times AS (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS wall FROM orders)"
_PACIFIC = "AT TIME ZONE 'America/Los_Angeles' AT TIME ZONE 'UTC'"
_RANGE = "ts > TIMESTAMP '2024-01-05 10:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'"
_ENDS = r"replace(replace(replace(text, '. ', '.' || chr(13) || chr(10)), chr(10), '\n'), chr(13), '\n')"

def _row_sql(columns) -> str:
    return " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)


_RANGES = """WITH days AS (SELECT DISTINCT o_custkey, unnest(range(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 61 AS INT), INTERVAL 1 DAY)) AS day FROM orders),
islands AS (SELECT o_custkey, day, day - CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY day) AS INT) * INTERVAL 1 DAY AS island FROM days),
ranges AS (SELECT o_custkey, CAST(min(day) AS DATE) AS low, CAST(max(day) AS DATE) + 1 AS high FROM islands GROUP BY o_custkey, island)
"""

ORACLE = {
    "loaded_ranges": _RANGES + "SELECT * FROM ranges",
    "missing_ranges": _RANGES + """SELECT * FROM (
  SELECT o_custkey, high AS low, lead(low) OVER (PARTITION BY o_custkey ORDER BY low) AS high FROM ranges) WHERE high IS NOT NULL""",
    "part_fingerprints": f"""WITH hashed AS (SELECT p_partkey % 64 AS bucket, md5({_row_sql(PART_COLUMNS)}) AS h FROM part)
SELECT bucket, count(*) AS n, CAST(sum(CAST('0x' || h[1:15] AS HUGEINT)) AS VARCHAR) AS total, bit_xor(CAST('0x' || h[17:31] AS BIGINT)) AS mixed
FROM hashed GROUP BY 1""",
    "part_changes": """SELECT DISTINCT p_partkey % 64 AS bucket, p_partkey % 64 <> 20 AS kept FROM part
WHERE p_partkey % 64 IN (9, 20) OR p_partkey IN (3, 70)""",
    "safe_cast": f"""WITH {_RAW} SELECT event_id,
  CASE WHEN regexp_matches(raw, '^\\s*[0-9]+\\s*$') THEN CAST(trim(raw) AS BIGINT) END AS int_value,
  coalesce(raw, 'None') AS text_compat, coalesce(raw <> '', false) AS flag_compat, CAST(flag AS BIGINT) AS flag_int
FROM raw_events""",
    "pacific_to_utc": f"WITH {_WALL} SELECT o_orderkey, wall {_PACIFIC} AS utc FROM times",
    "utc_to_pacific_day": f"""WITH {_WALL}
SELECT o_orderkey, CAST(wall AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles' AS DATE) AS day FROM times""",
    "survey_to_utc": f"""WITH {_WALL} SELECT o_orderkey,
  CASE o_orderkey % 4 WHEN 0 THEN wall + INTERVAL 5 HOUR WHEN 1 THEN wall + INTERVAL 4 HOUR WHEN 2 THEN wall END AS utc,
  CASE WHEN o_orderkey % 4 < 3 THEN wall END AS stored,
  strftime(wall AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%d+%H:%M:%S') AS watermark FROM times""",
    "compact_dates": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day
FROM orders""",
    "calendar_bounds": """SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month_first, last_day(o_orderdate) AS month_last,
  o_orderdate < DATE '1999-12-30' AS settled FROM orders""",
    "incremental_scan": f"SELECT * FROM events WHERE {_RANGE} ORDER BY ts",
    "incremental_scan_limit": f"""SELECT event_id, ts FROM events
  WHERE {_RANGE} AND ts <= (SELECT max(ts) FROM (SELECT ts FROM events WHERE {_RANGE} ORDER BY ts LIMIT 500))""",
    "day_slices": """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-09' GROUP BY 1, 2""",
    "watermark": "SELECT coalesce(max(ts), TIMESTAMP '2010-05-01') AS watermark FROM events",
    "watermark_by_product": "SELECT event_type, max(ts) AS watermark FROM events GROUP BY 1",
    "watermark_source_day": """SELECT CAST(max(ts) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles' AS DATE) AS start
FROM events""",
    "id_range": "SELECT min(doc_id) AS min_id, max(doc_id) AS max_id FROM documents",
    "since_id": with_inputs("tweets", "SELECT id_str, created_at FROM tweets WHERE id_str > 100"),
    "append_dedup": """SELECT doc_id, lang, source, n_chars FROM documents
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)""",
    "month_overwrite": """SELECT o_orderkey, o_orderdate,
  CASE WHEN o_orderdate >= (SELECT date_trunc('month', max(o_orderdate)) FROM orders) THEN o_totalprice * 2
    ELSE o_totalprice END AS o_totalprice FROM orders""",
    "rules_changed": """SELECT topic, keywords, CAST(sum(sign) AS BIGINT) AS extra FROM (
  SELECT p_type AS topic, regexp_replace(p_name, '^red ', 'dark red ') AS keywords, 1 AS sign FROM part
  UNION ALL SELECT p_type, p_name, -1 FROM part) GROUP BY 1, 2 HAVING sum(sign) <> 0""",
    "vote_chunks": """SELECT o_orderkey, created, CASE WHEN created IS NULL THEN 3 WHEN created <= TIMESTAMP '1996-12-31' THEN 0
  WHEN created <= TIMESTAMP '1999-12-31' THEN 1 ELSE 2 END AS chunk
FROM (SELECT o_orderkey, nullif(o_orderdate, TIMESTAMP '1996-02-02') AS created FROM orders)""",
    "balanced_ranges": """SELECT count(*) AS n_rows, CAST(sum(CASE WHEN o_orderkey % 50 = 0 THEN 1 END) AS BIGINT) AS n_untimed,
  CAST(16 AS BIGINT) AS n_ranges, true AS disjoint, true AS balanced FROM orders""",
    # every cover of a query by phrases, of which the best is taken
    "translated_phrases": """WITH RECURSIVE parts AS (SELECT *, split_part(p_name, ' ', -1) AS second, lower(p_type) AS kind FROM part),
known AS (SELECT p_size, p_name AS phrase FROM parts WHERE p_size > 20
  UNION ALL SELECT p_size, second || ' ' || kind FROM parts WHERE p_size % 3 = 0
  UNION ALL SELECT p_size, kind || ' ' || p_partkey FROM parts WHERE p_partkey % 2 = 1
  UNION ALL SELECT p_size, second FROM parts WHERE p_size > 48
  UNION ALL SELECT p_size, p_name || ' ' || kind FROM parts WHERE p_size = 7),
entries AS (SELECT phrase, min(upper(replace(phrase, ' ', '_')) || '#' || p_size) AS said FROM known GROUP BY 1),
texts AS (SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_partkey AS q FROM part),
words AS (SELECT q, string_split(q, ' ') AS w FROM (SELECT DISTINCT q FROM texts)),
runs AS (SELECT q, w, i, n FROM words, unnest(range(1, len(w) + 1)) AS a(i), unnest(range(1, len(w) + 2 - i)) AS b(n)),
hits AS (SELECT q, i, n, said FROM runs JOIN entries ON phrase = lower(array_to_string(w[i : i + n - 1], ' '))
  UNION ALL SELECT q, i, 0, w[i] FROM runs WHERE n = 1),
covers AS (SELECT q, len(w) AS l, CAST(1 AS BIGINT) AS spot, CAST(0 AS BIGINT) AS covered, 0 AS pieces, CAST([] AS BIGINT[]) AS lens, CAST([] AS VARCHAR[]) AS said FROM words
  UNION ALL SELECT c.q, l, spot + greatest(n, 1), covered + n, pieces + CAST(n > 0 AS INT), list_append(lens, n), list_append(c.said, h.said)
  FROM covers c JOIN hits h ON h.q = c.q AND h.i = c.spot),
best AS (SELECT q, array_to_string(said, ' ') AS said FROM (SELECT *, row_number() OVER (PARTITION BY q
  ORDER BY covered DESC, pieces, lens DESC) AS place FROM covers WHERE spot > l) WHERE place = 1)
SELECT p_partkey, q AS original_query, said AS translated_query FROM texts JOIN best USING (q)""",
    "kb_votes_join": """SELECT c_custkey AS document_id, c_name AS title, c_mktsegment AS locale, l_shipdate AS created,
  l_linenumber AS helpful FROM lineitem, orders, customer
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_shipdate <= TIMESTAMP '1998-12-31'""",
    "conform_table": f"""SELECT doc_id AS id, CASE WHEN doc_id % 5 <> 0 THEN doc_id END AS thread_id, {_ENDS} AS content,
  n_chars AS author_id, (TIMESTAMP '2020-10-20' + to_seconds(doc_id * 40009)) {_PACIFIC} AS created,
  CASE WHEN doc_id % 7 <> 0 THEN TIMESTAMP '2020-03-08 10:30:00' END AS updated, CAST(NULL AS BIGINT) AS updated_by_id
FROM documents""",
    "conform_compat": f"""SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE 'None' END AS title,
  o_custkey AS forum_id, o_orderdate {_PACIFIC} AS created, CAST(trunc(o_totalprice) AS BIGINT) AS creator_id,
  o_custkey AS last_post_id, CAST(NULL AS BIGINT) AS replies, o_orderstatus <> 'O' AS is_locked,
  o_orderkey % 2 = 1 AS is_sticky FROM orders""",
}

"""Mirror specs, readers and sinks: given tables conformed, or written to staged files and read back."""

from __future__ import annotations


from pyspark.sql import functions as F

from supportlens.operators import measures, mirror, releases
from supportlens.plans.inputs import load
from supportlens.plans.report_queries import QUERIES as REPORTS, release_documents
from supportlens.schemas import MIRROR, mirror_kinds, table
from supportlens.sources import readers, sinks

# What stands in the source for each kind of column, by its place p, and what the mirror makes of it: in Spark and SQL.
_SOURCE = {
    "int": "case when (doc_id + {p}) % 5 = 0 then 'none' else cast(doc_id * {p} as string) end",
    "int!": "cast(doc_id + {p} as string)",
    "str": "case when (doc_id + {p}) % 6 <> 0 then source || '-' || doc_id end",
    "text": "replace(text, '. ', '.\\r\\n')",
    "bool": "(doc_id + {p}) % 3 = 0",
    "date": "case when (doc_id + {p}) % 4 = 0 then 'never' else cast(date_add(date'2020-01-01', cast(doc_id % 900 as int)) as string) end",
    "utc": "timestamp_ntz'2020-10-20 00:00:00' + (doc_id * 40009 + {p}) * interval '1' second",
}
_MIRRORED = {
    "int": "CASE WHEN (doc_id + {p}) % 5 <> 0 THEN doc_id * {p} END",
    "int!": "doc_id + {p}",
    "str": "CASE WHEN (doc_id + {p}) % 6 <> 0 THEN source || '-' || doc_id END",
    "text": r"replace(replace(replace(text, '. ', '.' || chr(13) || chr(10)), chr(10), '\n'), chr(13), '\n')",
    "bool": "(doc_id + {p}) % 3 = 0",
    "date": "CASE WHEN (doc_id + {p}) % 4 <> 0 THEN DATE '2020-01-01' + CAST(doc_id % 900 AS INTEGER) END",
    "utc": "(TIMESTAMP '2020-10-20' + to_seconds(doc_id * 40009 + {p})) AT TIME ZONE 'America/Los_Angeles' AT TIME ZONE 'UTC'",
}


def _mirrored(name: str):
    def query(spark, sf):
        kinds = [kind for _, kind in mirror_kinds(MIRROR[name])]
        docs = load(spark, sf, "documents")
        return mirror.conform(docs.select(*[F.expr(_SOURCE[k].format(p=i + 1)).alias(f"c{i}") for i, k in enumerate(kinds)]), name)

    return query


def _mirrored_sql(name: str) -> str:
    kinds = mirror_kinds(MIRROR[name])
    return "SELECT " + ", ".join(f"{_MIRRORED[k].format(p=i + 1)} AS {column}" for i, (column, k) in enumerate(kinds)) + " FROM documents"


_ROWS = table("doc_id: long, text: string, source: string, n_chars: long")


def _documents(spark, sf):
    return load(spark, sf, "documents").select("doc_id", "text", "source", "n_chars")


def _csv(spark, sf):
    path = sinks.staging(spark, "csv")
    sinks.write_csv(_documents(spark, sf), path, quote_all=True)
    return readers.check_bad_rows(readers.read_csv(spark, path, _ROWS, multi_line=True), 0)


def _tsv(spark, sf):
    path = sinks.staging(spark, "tsv")
    sinks.write_csv(load(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"), path, sep="\t")
    schema = table("p_partkey: long, p_name: string, p_retailprice: double")
    return readers.check_bad_rows(readers.read_csv(spark, path, schema, sep="\t"), 0)


def _utf16(spark, sf):
    path = sinks.staging(spark, "utf16")
    sinks.write_csv(_documents(spark, sf), path, quote_all=True, encoding="UTF-16")
    return readers.read_store_reviews(spark, path, _ROWS)


def _ndjson(spark, sf):
    path = sinks.staging(spark, "json")
    sinks.write_ndjson(_documents(spark, sf).withColumn("source", F.expr("nullif(source, 'src3')")), path)
    return readers.read_json(spark, path, _ROWS)


def _months(spark, sf):
    """Orders by month; the months of the last year's half arrive again with other amounts."""
    path = sinks.staging(spark, "months")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    sinks.write_months(orders, path, "o_orderdate")
    again = orders.where("o_orderdate >= timestamp_ntz'1998-01-01 00:00:00'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sinks.write_months(again, path, "o_orderdate")
    return spark.read.parquet(path).select("o_orderkey", "o_orderdate", "o_totalprice")


def _rules(spark, sf):
    path = sinks.staging(spark, "rules")
    sinks.write_csv(load(spark, sf, "part").select(F.col("p_type").alias("topic"), F.col("p_name").alias("keywords")), path, sep="\t")
    return readers.read_rules(spark, path)


def _lines(spark, sf):
    path = sinks.staging(spark, "lines")
    lines = load(spark, sf, "part").select(F.when(F.col("p_partkey") % 7 > 0, F.concat("p_name", F.lit("  "))).otherwise("").alias("value"))
    lines.write.text(path)
    return readers.read_lines(spark, path)


def _calendar_after(spark, sf):
    return releases.release_calendar(releases.release_rows(release_documents(spark, sf)), weeks_before=0)


def _weekly_searches(spark, sf):
    series = REPORTS["trend_series"](spark, sf)
    return measures.weekly_change(series, "timestamp", ["original_query"], F.col("relative_search_volume"))


QUERIES = {
    **{f"mirror_{name}": _mirrored(name) for name in MIRROR},
    "csv_round_trip": _csv,
    "tsv_round_trip": _tsv,
    "utf16_round_trip": _utf16,
    "ndjson_round_trip": _ndjson,
    "month_files": _months,
    "rule_file": _rules,
    "line_file": _lines,
    "release_calendar_after": _calendar_after,
    "weekly_search_change": _weekly_searches,
}

_DOCUMENTS = "SELECT doc_id, text, source, n_chars FROM documents"

ORACLE = {
    **{f"mirror_{name}": _mirrored_sql(name) for name in MIRROR},
    "csv_round_trip": _DOCUMENTS,
    "tsv_round_trip": "SELECT p_partkey, p_name, p_retailprice FROM part",
    "utf16_round_trip": _DOCUMENTS,
    "ndjson_round_trip": "SELECT doc_id, text, nullif(source, 'src3') AS source, n_chars FROM documents",
    "month_files": """SELECT o_orderkey, o_orderdate,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
    "rule_file": "SELECT p_type AS topic, p_name AS keywords FROM part",
    "line_file": "SELECT rtrim(p_name) AS value FROM part WHERE p_partkey % 7 > 0",
    "release_calendar_after": """SELECT 'r-' || p_partkey AS release, p_brand AS product, p_type AS category,
  p_partkey AS build_number, DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS release_date,
  (p_size + 30) || '.0.1' AS version, CASE WHEN p_size > 25 THEN p_name ELSE '' END AS description,
  p_size > 40 AS is_security_driven, DATE '2020-01-01' + CAST(p_partkey % 1000 + k AS INTEGER) AS date_utc,
  k + 1 AS day_num, CAST(floor(k / 7) AS BIGINT) + 1 AS week_num
FROM part, (SELECT unnest(range(0, 56)) AS k) WHERE p_size + 30 >= 57""",
    "weekly_search_change": """WITH weeks AS (SELECT event_type AS original_query, CAST(date_trunc('week', ts) AS DATE) AS week,
  count(*) AS total FROM events GROUP BY 1, 2)
SELECT w.original_query, w.week, w.total, (w.total - b.total) / b.total * 100 AS change_pct
FROM weeks w LEFT JOIN weeks b ON w.original_query = b.original_query AND b.week = w.week - 7""",
}

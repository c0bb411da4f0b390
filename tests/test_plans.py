"""Properties of the plans that decide how they hold on large tables."""

import re

import pytest

import __spark_entry__ as entry
import oracle_check

FOLDER = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
QUERIES = {name: q for name, q in entry.queries().items() if q.__module__.startswith("supportlens.plans")}

JOINS = [
    "question_first_response", "over_24h_response", "reply_enrich", "reply_first_response", "ga_listed_users",
    "ga_segment_by_page_by_product", "ga_search_ctr", "append_dedup", "month_overwrite", "kb_votes_join", "trend_queries",
]


@pytest.fixture
def no_small_sides(spark):
    """Every side counts as large, as on a cluster."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def plan_of(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_and_no_python(spark, no_small_sides, name):
    plan = plan_of(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in plan
    assert not re.search(r"\bBroadcastHashJoin\b", plan)  # nothing is broadcast whatever its size


@pytest.mark.parametrize("name", JOINS)
def test_joins_without_broadcast_agree(spark, no_small_sides, name):
    same, told = oracle_check.compare(spark, oracle_check.connect(FOLDER), QUERIES[name], ORACLE[name], FOLDER)
    assert same, told


@pytest.mark.parametrize("name", ["ga_segment_users", "ga_segment_by_page_by_product", "ga_search_ctr", "ga_kb_exit_rate", "ga_question_exit_rate"])
def test_hits_are_scanned_once(spark, no_small_sides, name):
    plan = plan_of(spark, name)
    assert len(re.findall(r"FileScan parquet", plan)) == 1 and "SortAggregate" not in plan and "n_name" not in plan


def test_first_responses_are_joined_once(spark, no_small_sides):
    assert len(re.findall(r"SortMergeJoin", plan_of(spark, "over_24h_response"))) == 2
    assert len(re.findall(r"FileScan parquet", plan_of(spark, "reply_first_response"))) <= 2


@pytest.mark.parametrize("name", ["latest_question", "latest_answer", "question_first_response"])
def test_one_row_a_key_and_task_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan_of(spark, name))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("term_freq_daily", {"doc_id", "text"}),
        ("ga_total_users", {"ts", "user_id"}),
        ("watermark", {"ts"}),
        ("reply_first_response", {"doc_id"}),
        ("question_first_response", {"conv_id", "turn", "role"}),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(spark, name))
    assert {c.split(":")[0] for schema in read for c in schema.split(",") if c} == columns


@pytest.mark.parametrize(
    "name, costly", [("topic_counts", "RLIKE"), ("language_filter", "regexp_extract_all"), ("release_calendar", "from_json"), ("report_flatten", "from_json")]
)
def test_costly_columns_are_not_repeated_in_filters(spark, name, costly):
    filters = [line for line in plan_of(spark, name).splitlines() if re.search(r"\) Filter|- Filter|DataFilters", line)]
    assert not any(costly in line for line in filters)


def test_filters_reach_the_files(spark):
    plan = plan_of(spark, "incremental_scan")
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_top_of_a_range_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "incremental_scan_limit")

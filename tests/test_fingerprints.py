"""Order-free fingerprints and reloads of changed buckets."""

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from supportlens.operators import tables

ROWS = "k bigint, t string, d date, f double, a array<int>"


def rows(n=200):
    return [(i % 90, f"text {i % 40}", date(2024, 1, 1 + i % 20) if i % 7 else None, i / 3, [i % 3, None]) for i in range(n)]


def told(spark, data, parts=3):
    df = spark.createDataFrame(data, ROWS).repartition(parts)
    return sorted(map(tuple, tables.fingerprints(df, df.columns, [(F.col("k") % 4).alias("part")]).collect()))


def test_order_and_tasks_are_no_matter(spark):
    data = rows()
    once = told(spark, data)
    random.Random(1).shuffle(data)
    assert told(spark, data, 7) == once and len(once) == 4 and sum(r[1] for r in once) == 200


@pytest.mark.parametrize("change", [
    lambda d: d[:-1], lambda d: d + d[:1], lambda d: d + d[:1] * 2, lambda d: [(d[0][0], "other", *d[0][2:]), *d[1:]],
    lambda d: [(*d[0][:2], None, *d[0][3:]), *d[1:]], lambda d: [(*d[0][:4], [0]), *d[1:]], lambda d: [(*d[0][:3], -0.5, d[0][4]), *d[1:]],
])
def test_changes_are_seen(spark, change):
    data = [(1, "a", date(2024, 1, 1), 1.5, [1]), *rows(40)]
    assert told(spark, data) != told(spark, change(list(data)))


def test_values_do_not_run_together(spark):
    pairs = [("a", "bc"), ("ab", "c"), ("", "abc"), (None, "abc"), ("abc", None), ("abc", ""), ("1:a", "b"), ("-", ""), ("", "-")]
    texts = {tuple(r) for r in spark.createDataFrame(pairs, "x string, y string").transform(lambda d: d.select(tables.row_text(d, ["x", "y"]))).collect()}
    assert len(texts) == len(pairs)


def test_no_rows_are_shuffled(spark):
    df = spark.createDataFrame(rows(), ROWS)
    plan = tables.fingerprints(df, df.columns, ["k"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange"):]
    assert plan.count("Exchange") == 1 and "partial_count" in exchange


def test_reload_writes_changed_buckets_only(spark, tmp_path):
    path, data = str(tmp_path / "t"), rows()
    load = lambda d: tables.reload_changed(spark.createDataFrame(d, ROWS), path, "k", 16)
    stored = lambda: sorted(map(str, spark.read.parquet(f"{path}/rows").drop("_bucket").collect()))
    want = lambda d: sorted(map(str, spark.createDataFrame(d, ROWS).collect()))
    assert len(load(data)) == 16 and stored() == want(data)
    random.Random(2).shuffle(data)
    assert load(data) == [] and stored() == want(data)
    files = {d: set(os.listdir(f"{path}/rows/{d}")) for d in os.listdir(f"{path}/rows") if "=" in d}
    changed = [(k, "new", *rest) if k == 5 else (k, t, *rest) for k, t, *rest in data]
    touched = load(changed)
    assert len(touched) == 1 and stored() == want(changed)
    now = {d: set(os.listdir(f"{path}/rows/{d}")) for d in files}
    assert {d for d in files if files[d] != now[d]} == {f"_bucket={touched[0]}"}
    fewer = [r for r in changed if r[0] < 3]
    load(fewer)
    assert stored() == want(fewer) and load(fewer) == []

"""Latest versions kept up to date, against all versions at once."""

import os
import random
from datetime import datetime, timedelta

import pytest

from supportlens.operators.forum import latest
from supportlens.streaming import files
from supportlens.streaming.latest import keep_latest, latest_versions, merge_all, merge_versions

VERSIONS = "id bigint, updated timestamp_ntz, body string"


def versions(seed, n=400, keys=60):
    rng = random.Random(seed)
    day = lambda: datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(10**6))
    return [(rng.choice([None, 7] + list(range(keys)) * 2), rng.choice([None, day(), day()]), f"text {i}") for i in range(n)]


def brute(rows):
    best = {}
    for i, updated, body in rows:
        best.setdefault(i, []).append((updated is not None, updated or datetime.min))
    return {i: max(v)[1] if max(v)[0] else None for i, v in best.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_batches_in_any_order(spark, tmp_path, seed):
    rows, rng, tables = versions(seed), random.Random(seed), []
    for attempt in range(3):
        order = rows[:] + rng.sample(rows, 50 * attempt)
        rng.shuffle(order)
        cuts = sorted(rng.sample(range(len(order)), attempt + 1))
        parts = [order[a:b] for a, b in zip([0, *cuts], [*cuts, len(order)])]
        batches = [spark.createDataFrame(p, VERSIONS) for p in parts]
        tables.append(sorted(map(tuple, merge_all(batches, str(tmp_path / f"t{attempt}"), "id", buckets=8).collect()), key=repr))
    assert tables[0] == tables[1] == tables[2]
    assert {r[0]: r[1] for r in tables[0]} == brute(rows) and len(tables[0]) == len(brute(rows))
    dated = {r.id: r.updated for r in latest(spark.createDataFrame(rows, VERSIONS), "id").collect()}
    assert dated == brute(rows)


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_versions(spark.createDataFrame(versions(4), VERSIONS), path, "id", buckets=16)
    before = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("_bucket")}
    touched = merge_versions(spark.createDataFrame([(3, datetime(2030, 1, 1), "new"), (1000, None, "first")], VERSIONS), path, "id", buckets=16)
    after = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("_bucket")}
    assert {d for d in after if after[d] != before.get(d)} == {f"_bucket={b}" for b in touched} and len(touched) <= 2
    now = {r.id: r.body for r in latest_versions(spark, path).collect()}
    assert now[3] == "new" and now[1000] == "first" and len(now) == len(brute(versions(4))) + 1


def test_a_batch_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert merge_versions(spark.createDataFrame([], VERSIONS), path, "id") == []
    merge_versions(spark.createDataFrame([(1, None, "a")], VERSIONS), path, "id")
    assert merge_versions(spark.createDataFrame([], VERSIONS), path, "id") == []
    assert [tuple(r) for r in latest_versions(spark, path).collect()] == [(1, None, "a")]


def test_as_a_stream(spark, tmp_path):
    rows = versions(5, n=120)
    for n in range(3):
        part = spark.createDataFrame(rows[n::3], VERSIONS)
        part.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = files.file_stream(spark, str(tmp_path / "in"), part.schema)
        keep_latest(stream, str(tmp_path / "t"), "id", str(tmp_path / "check"), buckets=8).awaitTermination()
    assert {r.id: r.updated for r in latest_versions(spark, str(tmp_path / "t")).collect()} == brute(rows)

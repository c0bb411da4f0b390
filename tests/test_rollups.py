"""Distinct users from merged bitmaps against counts over the hits."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from supportlens.operators import rollups

HITS = "user_id string, ts timestamp_ntz, country string, page string"


def visits(seed, n=3000):
    rng = random.Random(seed)
    return [
        (rng.choice([None, "hot"] + [f"u{rng.randrange(900)}"] * 4), datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(60 * 24 * 70)),
         rng.choice(["de", "fr", None]), f"/p{rng.randrange(4)}") for _ in range(n)
    ]


def brute(rows, key):
    users, hits = {}, {}
    for r in rows:
        users.setdefault(key(r), set()).add(r[0])
        hits[key(r)] = hits.get(key(r), 0) + 1
    return {k: (len(v - {None}), hits[k]) for k, v in users.items()}


@pytest.fixture
def loads(spark):
    """Hits in two loads, the numbers of their users, and the rollup of both."""
    rows = visits(1)
    early = [r for r in rows if r[1] < datetime(2024, 2, 1)]
    first, second = spark.createDataFrame(early, HITS), spark.createDataFrame([r for r in rows if r not in early], HITS)
    codes = rollups.new_codes(first, None)
    more = rollups.new_codes(second, codes)
    codes = codes.union(more)
    rollup = rollups.daily_users(first, codes, ["country", "page"]).union(rollups.daily_users(second, codes, ["country", "page"]))
    return rows, codes, rollup


def test_numbers(loads):
    rows, codes, _ = loads
    found = codes.collect()
    assert {r.user for r in found} == {r[0] for r in rows} - {None} and len(found) == len({r.code for r in found})
    assert max(r.code for r in found) < 12 * rollups.PLACES


def test_numbers_stay(spark):
    """New users never take a number that is given, whatever they are; a repeated load adds none."""
    known = None
    for part in range(4):
        hits = spark.createDataFrame([(f"u{i}",) for i in range(part * 3000, part * 3000 + 5000)], "user_id string")
        fresh = rollups.new_codes(hits, known)
        known = spark.createDataFrame((fresh if known is None else known.union(fresh)).collect(), "user string, code bigint")
        assert rollups.new_codes(hits, known).count() == 0
    codes = [r.code for r in known.collect()]
    assert len(codes) == len(set(codes)) == 14_000


@pytest.mark.parametrize("period", ["week", "month", None])
def test_users_over_periods(loads, period):
    rows, _, rollup = loads
    week = lambda t: (t - timedelta(days=t.weekday())).date()
    first = {"week": week, "month": lambda t: t.date().replace(day=1), None: lambda t: None}[period]
    expression = None if period is None else F.to_date(F.date_trunc(period, "day"))
    for dims in ([], ["country"], ["page"], ["country", "page"]):
        place = {"country": 2, "page": 3}
        want = brute(rows, lambda r: (*([first(r[1])] if period else []), *(r[place[d]] for d in dims)))
        got = {tuple(r)[:-2]: (r.users, r.hits) for r in rollups.users_over(rollup, expression, dims).collect()}
        assert got == want


def test_plan_reads_no_hits(spark, tmp_path, loads):
    _, _, rollup = loads
    rollup.write.parquet(str(tmp_path / "rollup"))
    merged = rollups.users_over(spark.read.parquet(str(tmp_path / "rollup")), F.date_trunc("month", "day"))
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "user_id" not in plan and plan.count("Relation") == 1 and "Expand" not in plan


def test_empty(spark):
    none = spark.createDataFrame([], HITS)
    codes = rollups.new_codes(none, None)
    assert rollups.users_over(rollups.daily_users(none, codes, ["page"]), None, ["page"]).count() == 0

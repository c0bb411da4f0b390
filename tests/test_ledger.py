"""Loaded ranges against sets of days, and loads that fail or come late against one clean load."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from supportlens.operators import ledger

D0, T0 = date(2024, 1, 1), datetime(2024, 1, 1)
ROWS = "id bigint, ts timestamp_ntz, arrived timestamp_ntz, word string"


def day(n):
    return D0 + timedelta(days=n)


@pytest.mark.parametrize("seed", range(3))
def test_ranges_like_sets_of_days(spark, seed):
    rng = random.Random(seed)
    rows = [(k, day(a), day(a + rng.randrange(-1, 6))) for k in "abc" for a in (rng.randrange(60) for _ in range(12))] + [("a", None, day(3))]
    df = spark.createDataFrame(rows, "job string, low date, high date")
    for frame, holes in ((ledger.merged_ranges(df, ["job"]), False), (ledger.missing_ranges(df, ["job"]), True)):
        found = {}
        for r in frame.collect():
            days = {r.low + timedelta(days=i) for i in range((r.high - r.low).days)}
            assert days and not days & found.setdefault(r.job, set())
            found[r.job] |= days
        for job in "abc":
            own = {low + timedelta(days=i) for j, low, high in rows if j == job and low for i in range((high - low).days)}
            span = {min(own) + timedelta(days=i) for i in range((max(own) - min(own)).days + 1)}
            assert found.get(job, set()) == (span - own if holes else own)


def counts(df):
    return df.groupBy(F.to_date("ts").alias("day"), "word").agg(F.count(F.lit(1)).alias("n"))


def arrivals(seed, n=400):
    """Rows of three weeks; most arrive at once, some up to ten days later."""
    rng, out = random.Random(seed), []
    for i in range(n):
        ts = T0 + timedelta(minutes=rng.randrange(21 * 1440))
        out.append((i, ts, ts + timedelta(minutes=rng.choice([1, 1, 1, 600, 5000, 14_000])), f"w{rng.randrange(5)}"))
    return out + [(n, None, T0, "w0")]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_loads_end_like_one(spark, tmp_path, monkeypatch, seed):
    """Loads on some days, one that writes its days and fails before the ledger knows, late rows throughout."""
    df = spark.createDataFrame(arrivals(seed), ROWS)
    clean, kept, book = (str(tmp_path / x) for x in ("clean", "kept", "book"))
    end = T0 + timedelta(days=40)
    ledger.load_due(df, counts, clean, str(tmp_path / "other"), end, "ts", "arrived")
    loads = sorted(random.Random(seed).sample(range(2, 30), 5))
    for n, at in enumerate(loads):
        if n == 2:
            with pytest.raises(RuntimeError):
                ledger.load_due(df, lambda rows: failing(counts(rows)), kept, book, T0 + timedelta(days=at), "ts", "arrived")
            with monkeypatch.context() as m, pytest.raises(RuntimeError):
                m.setattr(ledger, "as_ranges", failing)
                ledger.load_due(df, counts, kept, book, T0 + timedelta(days=at), "ts", "arrived")
        ledger.load_due(df, counts, kept, book, T0 + timedelta(days=at), "ts", "arrived")
    assert ledger.load_due(df, counts, kept, book, end, "ts", "arrived")
    assert ledger.load_due(df, counts, kept, book, end, "ts", "arrived") == []
    tables = [sorted(map(str, spark.read.parquet(p).select("day", "word", "n").collect())) for p in (clean, kept)]
    assert tables[0] == tables[1]


def failing(df):
    raise RuntimeError("no space left")


def test_only_late_days_are_due(spark, tmp_path):
    rows = [(i, T0 + timedelta(days=i), T0 + timedelta(days=i, hours=1), "w") for i in range(6)]
    target, book = str(tmp_path / "t"), str(tmp_path / "b")
    load = lambda data, at: ledger.load_due(spark.createDataFrame(data, ROWS), counts, target, book, T0 + timedelta(days=at), "ts", "arrived")
    assert load(rows, 4) == [day(0), day(1), day(2), day(3)]
    late = rows + [(9, T0 + timedelta(days=1, hours=5), T0 + timedelta(days=5), "late")]
    assert load(late, 6) == [day(1), day(4), day(5)]
    ranges = {(r.low, r.high) for r in ledger.read_ledger(spark, book).collect()}
    assert ranges == {(day(0), day(4)), (day(1), day(2)), (day(4), day(6))}
    assert [tuple(r) for r in ledger.missing_ranges(ledger.read_ledger(spark, book)).collect()] == []

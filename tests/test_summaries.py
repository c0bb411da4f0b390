"""Merged daily summaries of terms against full counts, and range cuts under skew."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from supportlens.operators import mirror, terms


def daily(spark, rng, days, words, flat):
    rows = []
    for d in range(days):
        for w in range(words):
            n = rng.randrange(1, 5) if flat else int(3000 / (1 + w) ** 1.2) + rng.randrange(3)
            if rng.random() < 0.8:
                rows.append((date(2024, 1, 1) + timedelta(days=d), f"w{w:04d}", n))
    return spark.createDataFrame(rows, "tweet_dt date, tweet_word string, tweet_freq bigint")


@pytest.mark.parametrize(("flat", "told"), [(False, True), (True, False)])
def test_merged_summaries_give_the_exact_top(spark, flat, told):
    counts = daily(spark, random.Random(3), 9, 400, flat)
    short = terms.term_summaries(counts, 60).cache()
    for days in (9, 4):  # any range of days merges the summaries made once
        until = F.col("tweet_dt") < F.lit(date(2024, 1, 1) + timedelta(days=days))
        candidates = terms.summary_candidates(short.where(until), 10)
        assert (candidates is not None) == told
        if told:
            assert 10 <= candidates.count() < 200
        got = terms.top_terms_merged(short.where(until), counts.where(until), 10).collect()
        assert got == terms.top_terms(counts.where(until), 10).collect()


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold(spark, seed):
    rng = random.Random(seed)
    counts = daily(spark, rng, 3, 30, seed % 2 == 0)
    size = rng.choice([1, 7, 29, 40])
    short = {}
    for r in terms.term_summaries(counts, size).collect():
        short.setdefault(r.tweet_dt, {})[r.tweet_word] = r
    for day in {r.tweet_dt for r in counts.collect()}:
        full = {r.tweet_word: r.tweet_freq for r in counts.where(F.col("tweet_dt") == day).collect()}
        own, bounds = short[day], {r.bound for r in short[day].values()}
        assert len(own) == min(size, len(full)) and len(bounds) == 1
        assert all(own[w].tweet_freq == full[w] for w in own)
        left = [n for w, n in full.items() if w not in own]
        assert bounds == {max(left, default=0)}
    for n in (1, 5, 50):
        frame = terms.term_summaries(counts, size)
        assert terms.top_terms_merged(frame, counts, n).collect() == terms.top_terms(counts, n).collect()


def test_no_summaries(spark):
    none = spark.createDataFrame([], "tweet_dt date, tweet_word string, tweet_freq bigint")
    assert terms.top_terms_merged(terms.term_summaries(none), none, 5).collect() == []


def test_top_terms_of_a_day_are_cut_before_the_shuffle(spark):
    plan = terms.term_summaries(daily(spark, random.Random(1), 2, 20, True))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def sizes(df, column, cuts):
    """Rows of each range: by number, and by the conditions for the source."""
    numbers = {r.chunk: r.n for r in mirror.range_chunks(df, column, cuts).groupBy("chunk").agg(F.count("*").alias("n")).collect()}
    tests = mirror.range_predicates(column, cuts)
    assert [df.where(t).count() for t in tests] == [numbers.get(i, 0) for i in range(len(tests))]
    assert sum(numbers.values()) == df.count()
    return [numbers.get(i, 0) for i in range(len(tests) - 1)]


def test_cuts_balance_a_skewed_column(spark):
    df = spark.range(20_000, numPartitions=7).select(
        F.when(F.col("id") % 40 > 0, F.pow(F.col("id") % 997, F.lit(4)).cast("bigint")).alias("number"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + cast(pow(id % 997, 3) as bigint) * interval '1' second").alias("clock"),
        F.expr("date_add(date'2000-01-01', cast(sqrt(id) * 20 as int))").alias("day"),
    )
    for column in ("number", "clock", "day"):
        greatest, cuts = mirror.balanced_cuts(df, column, 8)
        assert greatest == df.agg(F.max(column)).first()[0] and cuts == sorted(set(cuts)) and len(cuts) == 7
        found = sizes(df, column, cuts)
        assert max(found) <= 1.2 * sum(found) / 8
    fixed = sizes(df, "clock", [datetime(2024, 6, 1), datetime(2030, 1, 1)])
    assert max(fixed) > 1.2 * sum(fixed) / 3


def test_cuts_of_odd_columns(spark):
    one = spark.createDataFrame([(5,)] * 90 + [(k,) for k in range(10)], "v int")
    greatest, cuts = mirror.balanced_cuts(one, "v", 10)
    assert greatest == 9 and 5 in cuts  # a value is never split
    assert sum(sizes(one, "v", cuts)) == 100
    same = one.where("v = 5")
    assert mirror.balanced_cuts(same, "v", 10) == (5, []) and sizes(same, "v", []) == [91]
    assert mirror.balanced_cuts(one.where("v > 99"), "v", 4) == (None, [])
    assert mirror.balanced_cuts(one, "v", 1) == (9, [])

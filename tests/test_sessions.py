"""Sessions by inactivity against plain Python, in one load and day by day."""

import random
from datetime import datetime, timedelta

import pytest

from supportlens.operators import sessions, web

HITS = "hit_id bigint, user_id bigint, ts timestamp_ntz, page_path string, session_id string"
T0 = datetime(2024, 3, 1)


def brute(rows, gap=30):
    """Sorted (user, started, ended, hits, first page, last page)."""
    out = {}
    for hit, user, ts, page in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[1], r[2], r[0])):
        mine = out.setdefault(user, [])
        if mine and ts <= mine[-1][1] + timedelta(minutes=gap):
            mine[-1] = [mine[-1][0], ts, mine[-1][2] + 1, mine[-1][3], page]
        else:
            mine.append([ts, ts, 1, page, page])
    return sorted((user, *s) for user, mine in out.items() for s in mine)


def visits(seed, users=12, days=4):
    """Hits with gaps about the bound, sessions over midnight, equal times; one user has a third of all."""
    rng, rows = random.Random(seed), []
    for user in range(users):
        ts = T0 + timedelta(minutes=rng.randrange(600))
        for _ in range(400 if user == 0 else 70):
            ts += timedelta(minutes=rng.choice([0, 1, 5, 29, 30, 31, 90]), seconds=rng.choice([0, 0, 1]))
            rows.append((len(rows), user, ts, f"/p{rng.randrange(9)}"))
    rng.shuffle(rows)
    return rows + [(-1, None, T0, "/x"), (-2, 3, None, "/y")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "given") for r in rows], HITS)


@pytest.mark.parametrize("seed, gap", [(1, 30), (2, 30), (3, 5), (4, 90)])
def test_like_plain_python(spark, seed, gap):
    rows = visits(seed)
    found = sorted(map(tuple, sessions.sessions(frame(spark, rows), gap).collect()))
    assert found == brute(rows, gap)
    assert gap < 30 or any(s[1].date() != s[2].date() for s in found)


@pytest.mark.parametrize("seed", [5, 6])
def test_day_by_day_as_in_one_load(spark, tmp_path, seed):
    """Each day is loaded alone, with what the day before left open; a day without hits is a load too."""
    rows = visits(seed)
    days = sorted({r[2].date() for r in rows if r[2]})
    day, last, open_, done = datetime.combine(days[0], datetime.min.time()), days[-1], None, []
    n = 0
    while day.date() <= last + timedelta(days=2):
        part = frame(spark, [r for r in rows if r[2] and r[2].date() == day.date()])
        closed, rest = sessions.load_part(part, open_, day + timedelta(days=1))
        done += sessions.told(closed).collect()
        rest.write.parquet(str(tmp_path / f"open{n}"))
        open_, day, n = spark.read.parquet(str(tmp_path / f"open{n}")), day + timedelta(days=1), n + 1
    assert open_.count() == 0
    assert sorted(map(tuple, done)) == brute(rows)


def test_a_load_repeated(spark):
    """A load that is run again gives the same rows: it reads only what the last one left."""
    rows = visits(7)
    cut = T0 + timedelta(days=1)
    before, after = (frame(spark, [r for r in rows if r[2] and (r[2] < cut) == early]) for early in (True, False))
    _, open_ = sessions.load_part(before, None, cut)
    once, again = (sorted(map(str, sessions.load_part(after, open_, cut + timedelta(days=30))[0].collect())) for _ in range(2))
    assert once == again


def test_hits_with_sessions(spark):
    rows = visits(8)
    named = sessions.with_sessions(frame(spark, rows))
    assert sorted(named.columns) == ["hit_id", "page_path", "session_id", "ts", "user_id"] and named.count() == len(rows)
    by_session = {}
    for r in named.collect():
        if r.user_id is None or r.ts is None:
            assert r.session_id is None
        else:
            by_session.setdefault(r.session_id, []).append((r.user_id, r.ts))
    want = brute(rows)
    assert sorted((min(v)[0], min(v)[1], max(v)[1], len(v)) for v in by_session.values()) == [s[:4] for s in want]


def test_reports_count_them(spark):
    rows = [(1, 7, datetime(2024, 3, 1, 23, 50), "/a"), (2, 7, datetime(2024, 3, 2, 0, 10), "/b"), (3, 7, datetime(2024, 3, 2, 9, 0), "/c")]
    hits = sessions.with_sessions(frame(spark, rows)).selectExpr("*", "'InProduct' source", "'none' medium")
    report = {str(r.ga_date): (r.ga_users, r.ga_sessions) for r in web.traffic_segments(hits).collect()}
    assert report == {"2024-03-01": (1, 1), "2024-03-02": (1, 2)}


def test_empty(spark):
    none = frame(spark, [])
    assert sessions.sessions(none).count() == 0 and sessions.with_sessions(none).count() == 0

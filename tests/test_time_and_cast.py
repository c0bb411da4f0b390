"""Clock changes against the zone database, week windows, forgiving casts, the database mirror."""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supportlens import schemas
from supportlens.functions import time as tm
from supportlens.functions.cast import safe_cast
from supportlens.operators import mirror
from supportlens.operators.incremental import scan_submitted


def ntz(text):
    return F.expr(f"timestamp_ntz'{text}'")


@pytest.mark.parametrize(
    "wall, utc",
    [
        ("2020-04-09 13:13:42", "2020-04-09 20:13:42"),
        ("2020-11-01 01:30:00", "2020-11-01 09:30:00"),
        ("2020-11-01 00:30:00", "2020-11-01 07:30:00"),
        ("2020-11-01 02:30:00", "2020-11-01 10:30:00"),
        ("2020-03-08 02:30:00", "2020-03-08 10:30:00"),
    ],
)
def test_to_utc(one, wall, utc):
    assert str(one(tm.to_utc(ntz(wall)))) == utc
    assert str(one(tm.source_text_to_utc("t"), t=wall.replace(" ", "T") + "Z")) == utc


def test_two_years_of_half_hours(spark):
    zone, first = ZoneInfo("America/Los_Angeles"), datetime(2019, 6, 1)
    walls = [first + timedelta(minutes=30 * i) for i in range(2 * 365 * 48)]
    rows = spark.createDataFrame([(w,) for w in walls], T.StructType([T.StructField("w", T.TimestampNTZType())]))
    got = {r["w"]: r["u"] for r in rows.select("w", tm.to_utc("w").alias("u")).collect()}
    for wall in walls:
        later = wall.replace(tzinfo=zone, fold=1)
        back = later.astimezone(timezone.utc).astimezone(zone).replace(tzinfo=None)
        if back != wall:  # a wall clock the change skips: standard time holds
            assert got[wall] == wall + timedelta(hours=8)
        else:
            assert got[wall] == later.astimezone(timezone.utc).replace(tzinfo=None)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_session_zone_does_not_matter(spark, zone):
    rows = spark.range(1).select(ntz("2020-03-08 02:30:00").alias("at"), F.lit("2020-03-08 02:30:00 EST").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert scan_submitted(rows, "at", datetime(2020, 3, 8, 2, 31), datetime(2020, 3, 8, 2, 30)).count() == 1
        assert scan_submitted(rows, "at", datetime(2020, 3, 8, 2, 30)).count() == 0
        row = rows.select(tm.to_utc("at").alias("u"), tm.survey_text_to_utc("t").alias("s"), tm.week_start("at").alias("w")).first()
        assert tuple(row) == (datetime(2020, 3, 8, 10, 30), datetime(2020, 3, 8, 7, 30), date(2020, 3, 2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unreadable_source_time(one):
    assert one(tm.source_text_to_utc("t"), t="2020-04-09") is None


def test_survey_times(one):
    assert str(one(tm.survey_text_to_utc("t"), t="2019-07-13 23:49:22 EDT")) == "2019-07-14 03:49:22"
    assert str(one(tm.survey_text_to_utc("t"), t="2019-12-13 23:49:22 EST")) == "2019-12-14 04:49:22"
    assert str(one(tm.survey_text_to_utc("t", observed=True), t="2019-07-13 23:49:22 EDT")) == "2019-07-13 23:49:22"
    assert one(tm.survey_text_to_utc("t"), t="") is None
    assert one(tm.survey_watermark_text(ntz("2019-07-14 03:49:22"))) == "2019-07-13+23:49:22"


def test_seconds_truncate_toward_zero(one):
    a, b = ntz("2020-01-01 00:00:00.9"), ntz("2020-01-03 00:00:10")
    assert one(tm.seconds_between(a, b)) == 2 * 86400 + 9
    assert one(tm.seconds_between(b, a)) == -(2 * 86400 + 9)
    assert one(tm.seconds_between(a, ntz("2020-01-01 00:00:01.8"))) == 0


def test_weeks_and_months(one):
    assert tm.collection_week(date(2020, 4, 9), None) == (date(2020, 3, 30), date(2020, 4, 6))
    assert tm.collection_week(date(2020, 4, 6), date(2020, 3, 30)) == (date(2020, 3, 30), date(2020, 4, 6))
    assert tm.collection_week(date(2020, 4, 9), date(2020, 4, 6)) is None
    assert one(tm.week_start(F.lit(date(2020, 4, 12)))) == date(2020, 4, 6)
    assert one(tm.month_last(F.lit(date(2020, 2, 3)))) == date(2020, 2, 29)
    assert one(tm.compact_date("t"), t="20200409") == date(2020, 4, 9)
    assert one(tm.compact_date("t"), t="x") is None


def test_date_range(spark):
    days = [r["day"] for r in tm.date_range(spark, date(2020, 4, 9), date(2020, 4, 29)).orderBy("day").collect()]
    assert days[0] == date(2020, 4, 9) and days[-1] == date(2020, 4, 28) and len(days) == 20
    assert tm.date_range(spark, date(2020, 4, 9), date(2020, 4, 1)).count() == 0


def test_bounds_given_by_users():
    assert tm.parse_bound("2020-04-09") == datetime(2020, 4, 9)
    with pytest.raises(ValueError, match="not a valid date"):
        tm.parse_bound("soon")


@pytest.mark.parametrize(
    "value, kind, to, compat, wanted",
    [
        (5, "long", "str", False, "5"),
        ("5", "string", "int", False, 5),
        (" 5 ", "string", "int", False, 5),
        (" 5 ", "string", "int", True, 5),
        ("1_000", "string", "int", True, 1000),
        ("5.0", "string", "int", False, None),
        ("5.0", "string", "int", True, None),
        (5.9, "double", "int", False, 5),
        (True, "boolean", "int", False, 1),
        ("pickles", "string", "int", False, None),
        (None, "string", "int", True, None),
        ([1], "array<int>", "int", False, None),
        (None, "string", "str", True, "None"),
        (None, "string", "str", False, None),
        (True, "boolean", "str", True, "True"),
        (True, "boolean", "bool", False, True),
        (False, "boolean", "bool", True, False),
        (None, "boolean", "bool", True, False),
        ("False", "string", "bool", True, True),
        ("False", "string", "bool", False, False),
        ("", "string", "bool", True, False),
        (8, "long", "bool", True, True),
    ],
)
def test_safe_cast(spark, value, kind, to, compat, wanted):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert df.select(safe_cast(df, "v", to, compat).alias("v")).first()["v"] == wanted


SAMPLE = {"int": "7", "int!": "7", "str": "s", "text": "a\nb", "bool": "1", "utc": "2020-04-09 13:13:42", "date": "2020-04-09"}
WANTED = {
    "int": 7, "int!": 7, "str": "s", "text": "a\\nb", "bool": True, "utc": datetime(2020, 4, 9, 20, 13, 42),
    "date": date(2020, 4, 9),
}


@pytest.mark.parametrize("table", sorted(schemas.MIRROR))
def test_mirror_tables(spark, table):
    kinds = schemas.mirror_kinds(schemas.MIRROR[table])
    row = spark.range(1).select(*[F.lit(SAMPLE[k]).alias(f"c{i}") for i, (_, k) in enumerate(kinds)])
    typed = mirror.conform(row, table)
    assert typed.schema.names == [n for n, _ in kinds]
    assert [f.dataType for f in typed.schema] == [f.dataType for f in schemas.mirror_schema(schemas.MIRROR[table])]
    assert list(typed.first()) == [WANTED[k] for _, k in kinds]
    with pytest.raises(ValueError, match="columns expected"):
        mirror.conform(row.select("c0").withColumns({f"d{i}": F.lit("1") for i in range(len(kinds))}), table)


def test_hard_casts_fail(spark):
    row = spark.createDataFrame([("x", "t", "l", "2020-01-01 00:00:00", "1")], "a string, b string, c string, d string, e string")
    with pytest.raises(Exception, match="no whole number"):
        mirror.conform(row, "kb_votes").collect()


def test_dirty_rows_in_compat(spark):
    row = spark.createDataFrame([("1", None, "2", None, "x", "3", "4", "", None)], "a string, b string, c string, d string, e string, f string, g string, h string, i string")
    assert list(mirror.conform(row, "forums_thread", compat=True).first()) == [1, "None", 2, None, None, 3, 4, False, False]


def test_chunks_are_disjoint_and_whole(spark):
    days = [None] + [datetime(2013, 12, 30) + timedelta(hours=12 * i) for i in range(2500)]
    df = spark.createDataFrame([(d,) for d in days], T.StructType([T.StructField("created", T.TimestampNTZType())]))
    cut = mirror.range_chunks(df, "created")
    assert cut.count() == 2501
    df.createOrReplaceTempView("votes")
    for number, test in enumerate(mirror.range_predicates("created")):
        alone = spark.sql(f"select created from votes where {test}")
        assert alone.exceptAll(cut.where(f"chunk = {number}").select("created")).isEmpty()
        assert alone.count() == cut.where(f"chunk = {number}").count()

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from forumlens.functions import (
    as_id,
    distance,
    minutes_between,
    normalise_minutes,
    parse_date,
    round_half_even,
    slot_label,
    split_tags,
    time_slot,
)


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, v string")
    return [r[1] for r in df.select("n", expression.alias("x")).orderBy("n").collect()]


def test_ids(spark):
    given = ["7", "007", "-1", "+5", "", None, "abc", "7x", "1.5", "9" * 30, "7 ", " 7", "+", "-", "+-5", "1 2"]
    assert column(spark, given, as_id("v")) == [7, 7, -1, 5] + [None] * 12


def test_tags(spark):
    given = ["<a><b>", "<a><a>", "<>", "a", "", None, "<c=d>", "<c#><.net>"]
    want = [["a", "b"], ["a", "a"], [], ["a"], [], None, ["c", "d"], ["c#", ".net"]]
    assert column(spark, given, split_tags("v")) == want


def test_dates(spark):
    given = [
        "2008-08-01T00:59:33.643",
        "2008-02-30T00:00:00.000",
        "2008-08-01 00:59:33.643",
        "2008-08-01T00:59:33.64Z",
        "2008-08-01",
        "bad-date",
        "",
        None,
    ]
    want = [dt.datetime(2008, 8, 1, 0, 59, 33, 643000)] + [None] * 7
    assert column(spark, given, parse_date("v")) == want


def test_slots(spark):
    given = [f"2008-08-01T{h}:59:33.643" for h in ("00", "07", "13", "19")]
    assert column(spark, given, time_slot(parse_date("v"))) == [0, 1, 2, 3]
    assert column(spark, given, slot_label(time_slot(parse_date("v")))) == [f"TimeSlot{i}" for i in range(4)]
    assert column(spark, given, time_slot(parse_date("v"), 12)) == [0, 3, 6, 9]


@pytest.mark.parametrize("slots", [1, 2, 3, 4, 6, 8, 12, 24])
def test_slots_cover_the_day(spark, slots):
    hours = [f"2020-05-05T{h:02d}:00:00.000" for h in range(24)]
    found = column(spark, hours, time_slot(parse_date("v"), slots))
    assert found == [h // (24 // slots) for h in range(24)]
    assert set(found) == set(range(slots))


@pytest.mark.parametrize("slots", [0, -4, 5, 7, 48])
def test_uneven_slots_are_refused(slots):
    with pytest.raises(ValueError):
        time_slot("v", slots)


def test_minutes_truncate_toward_zero(spark):
    start = F.lit("2020-01-01T12:00:00.000")
    df = spark.range(1).select(parse_date(start).alias("asked"))
    ends = {
        "2020-01-01T12:01:59.999": 1,
        "2020-01-01T11:58:30.000": -1,
        "2020-01-01T11:59:30.000": 0,
        "2020-01-03T12:00:00.000": 2880,
        "nonsense": None,
    }
    for end, want in ends.items():
        got = df.select(minutes_between("asked", parse_date(F.lit(end)))).first()[0]
        assert got == want, end
        got = df.select(minutes_between("asked", parse_date(F.lit(end)), -1)).first()[0]
        assert got == (-1 if want is None else want)


def test_results_do_not_depend_on_the_zone(spark):
    """02:30 on this day does not exist in New York."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.range(1).select(
        parse_date(F.lit("2021-03-14T01:30:00.000")).alias("asked"),
        parse_date(F.lit("2021-03-14T02:30:00.000")).alias("answered"),
    )
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            row = df.select(minutes_between("asked", "answered"), time_slot("answered", 24)).first()
            assert tuple(row) == (60, 2), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rounding_and_distance(spark):
    row = spark.range(1).selectExpr(
        round_half_even("0.125D"),
        round_half_even("0.375D"),
        round_half_even("-0.125D"),
        normalise_minutes(f"{1590397 * 2}"),
        distance("0.0D", "0.0D", "3.0D", "4.0D"),
    ).first()
    assert tuple(row) == (0.12, 0.38, -0.12, 2.0, 5.0)

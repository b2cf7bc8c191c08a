"""Calendar rules on every civil day of 1999-2001."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from graticule.functions import calendars as C


@pytest.fixture(scope="module")
def days(spark):
    df = spark.range(1096).select(F.date_add(F.lit("1999-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    return C.with_standard_calendar(df.withColumn("dataset_id", F.lit("ref"))).cache()


def test_noleap_drops_29_february_and_counts_without_gap(days):
    rows = C.convert_calendar(days, "noleap").orderBy("date").collect()
    assert len(rows) == 3 * 365
    assert not any(r.date.month == 2 and r.date.day == 29 for r in rows)
    assert [r.t for r in rows] == list(range(rows[0].t, rows[0].t + 1095))
    assert {r.doy for r in rows} == set(range(1, 366))


@pytest.mark.parametrize("year, dropped", [
    (1999, ["02-06", "04-20", "07-02", "09-13", "11-25"]),
    (2000, ["01-31", "04-01", "06-01", "08-01", "10-01", "12-01"]),
])
def test_360_day_drops_evenly_spaced_days(days, year, dropped):
    n = C.days_in_year("calendar", "year")
    kept = days.where(F.col("year") == year).where(
        F.round(F.lit(360) * F.col("doy") / n) != F.round(F.lit(360) * (F.col("doy") - 1) / n)
    )
    gone = days.where(F.col("year") == year).join(kept, "date", "left_anti").orderBy("date")
    assert [r.date.strftime("%m-%d") for r in gone.collect()] == dropped


def test_other_calendars_raise_or_stay(days):
    days360 = C.convert_calendar(days, "360_day")
    for to in ("noleap", "standard"):
        with pytest.raises(Exception, match="cannot convert"):
            C.convert_calendar(days360, to).count()
        assert C.convert_calendar(days360, to, others="keep").collect() == days360.collect()
    with pytest.raises(Exception, match="cannot convert"):
        C.convert_calendar(C.convert_calendar(days, "noleap"), "standard").count()


def test_360_day_has_a_30_february_without_civil_date(days):
    out = C.convert_calendar(days, "360_day")
    assert out.count() == 3 * 360
    feb30 = out.where("month = 2 AND day = 30").collect()
    assert len(feb30) == 3 and all(r.date is None for r in feb30)
    assert out.where("date IS NULL").where("month <> 2").count() == 0


def test_gap_does_not_change_which_days_are_dropped(days):
    gap = days.where("date <> DATE'1999-02-05'")
    got = C.convert_calendar(gap, "360_day").where("year = 1999").count()
    assert got == 359


@pytest.mark.parametrize("freq, year, month, want", [
    ("QS-DEC", 2000, 12, "2000-12-01"), ("QS-DEC", 2001, 2, "2000-12-01"), ("QS-DEC", 2001, 3, "2001-03-01"),
    ("2QS-OCT", 2001, 4, "2001-04-01"), ("2QS-OCT", 2001, 9, "2001-04-01"), ("2QS-OCT", 2001, 1, "2000-10-01"),
    ("AS-JUL", 2001, 6, "2000-07-01"), ("AS-JUL", 2001, 7, "2001-07-01"), ("YS", 2001, 12, "2001-01-01"), ("MS", 2001, 5, "2001-05-01"),
])
def test_period_start(spark, freq, year, month, want):
    got = spark.range(1).select(C.period_start(F.lit(year), F.lit(month), freq).alias("d")).first().d
    assert got == dt.date.fromisoformat(want)


@pytest.mark.parametrize("calendar, year, month, freq, want", [
    ("standard", 2000, 1, "YS", 366), ("noleap", 2000, 1, "YS", 365), ("360_day", 2000, 1, "YS", 360),
    ("standard", 1999, 12, "QS-DEC", 91), ("noleap", 1999, 12, "QS-DEC", 90), ("standard", 2000, 2, "MS", 29),
])
def test_days_in_period(spark, calendar, year, month, freq, want):
    no = C.period_number(C.month_number(F.lit(year), F.lit(month)), freq)
    df = spark.range(1).select(F.lit(calendar).alias("calendar"), no.alias("p"))
    assert df.select(C.days_in_period("calendar", "p", freq).alias("n")).first().n == want


def test_unknown_calendar_raises(days):
    with pytest.raises(ValueError):
        C.convert_calendar(days, "julian")

"""Calendar arithmetic as column expressions.

A daily row carries ``calendar, year, month, day, doy, t`` where ``t`` counts days without gaps inside its calendar:

========== ====================================== ==========================
calendar   doy                                    t
========== ====================================== ==========================
standard   civil day of year                      days since 1900-01-01
noleap     civil day of year without 29 February  year*365 + doy - 1
360_day    round(360*doy/n), first of equal ones  year*360 + doy - 1
========== ====================================== ==========================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CALENDARS = ("standard", "noleap", "360_day")

# Frequency -> (length in months, first month counted from January = 0).
FREQUENCIES = {"MS": (1, 0), "YS": (12, 0), "AS-JUL": (12, 6), "QS-DEC": (3, 11), "2QS-OCT": (6, 9)}

_DAYS_BEFORE_MONTH = (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_leap(year: str | Column) -> Column:
    y = _c(year)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def days_in_year(calendar: str | Column, year: str | Column) -> Column:
    cal = _c(calendar)
    return (
        F.when(cal == "360_day", 360)
        .when((cal == "noleap") | ~is_leap(year), 365)
        .otherwise(366)
    )


def fixed_year_length(calendar: str | Column) -> Column:
    """Days per year of the calendars whose years are all equal; NULL for ``standard``."""
    cal = _c(calendar)
    return F.when(cal == "360_day", 360).when(cal == "noleap", 365)


def required_year_length(calendar: str | Column) -> Column:
    """Days per year of a calendar whose years are all equal; any other calendar stops the query."""
    cal = _c(calendar)
    problem = F.raise_error(F.concat(F.lit("years of equal length are needed, not calendar "), F.coalesce(cal, F.lit("NULL"))))
    return F.coalesce(fixed_year_length(cal), problem.cast("int"))


def with_standard_calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add the calendar columns for civil dates."""
    d = F.to_date(F.col(date_col))
    return df.withColumns({
        "date": d,
        "calendar": F.lit("standard"),
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "doy": F.dayofyear(d),
        "t": F.datediff(d, F.lit("1900-01-01").cast("date")),
    })


def ordinal(calendar: str, year: str | Column, doy: str | Column) -> Column:
    """Gap-free day number ``t`` of the fixed-length calendars."""
    n = {"noleap": 365, "360_day": 360}[calendar]
    return _c(year) * n + _c(doy) - 1


def with_civil_parts(df: DataFrame) -> DataFrame:
    """Rebuild ``month, day, date`` from ``calendar, year, doy`` (fixed-length calendars).

    ``date`` is NULL where the civil calendar has no such day (30 February).
    """
    is360 = F.col("calendar") == "360_day"
    noleap = F.date_add(F.lit("2001-01-01").cast("date"), F.col("doy") - 1)
    df = df.withColumns({
        "month": F.when(is360, F.expr("(doy - 1) div 30 + 1")).otherwise(F.month(noleap)).cast("int"),
        "day": F.when(is360, (F.col("doy") - 1) % 30 + 1).otherwise(F.dayofmonth(noleap)).cast("int"),
    })
    last = F.dayofmonth(F.last_day(F.make_date("year", "month", F.lit(1))))
    return df.withColumn("date", F.when(F.col("day") <= last, F.make_date("year", "month", "day")))


def _only(df: DataFrame, to: str, sources: tuple[str, ...], others: str) -> tuple[DataFrame, Column]:
    """``df`` and the condition of the rows to convert; other rows stop the query unless they are kept."""
    fits = F.coalesce(F.col("calendar").isin(*sources), F.lit(False))
    if others == "keep":
        return df, fits
    if others != "raise":
        raise ValueError(f"others is 'raise' or 'keep', not {others!r}")
    problem = F.raise_error(F.concat(F.lit(f"cannot convert to {to} from calendar "), F.coalesce(F.col("calendar"), F.lit("NULL"))))
    return df.where(F.when(fits, F.lit(True)).otherwise(problem.cast("boolean"))), F.lit(True)


def convert_calendar(df: DataFrame, to: str, others: str = "raise") -> DataFrame:
    """Drop the days the target calendar lacks and renumber the rest.  A projection and a filter: no shuffle.

    Rows of a calendar that cannot be converted (360_day to another, noleap to standard) stop the query with an error;
    with ``others="keep"`` they stay as they are, so members of several calendars go through together.

    ``noleap`` drops 29 February.  ``360_day`` keeps the first of the days that share ``round(360*doy/n)``, judged
    on the calendar itself, so a gap in the data does not change which days are dropped.
    """
    if to == "standard":
        return _only(df, to, ("standard",), others)[0]
    if to == "noleap":
        src, fits = _only(df, to, ("standard", "noleap"), others)
        std_leap = (F.col("calendar") == "standard") & is_leap("year")
        kept = src.where(~(std_leap & (F.col("month") == 2) & (F.col("day") == 29)))
        doy = (F.col("doy") - F.when(std_leap & (F.col("month") > 2), 1).otherwise(0)).cast("int")
        return kept.withColumn("doy", doy).withColumns({
            "calendar": F.when(fits, F.lit("noleap")).otherwise(F.col("calendar")),
            "t": F.when(fits, ordinal("noleap", "year", "doy").cast("int")).otherwise(F.col("t")),
        })
    if to == "360_day":
        n = days_in_year("calendar", "year")
        mapped = F.round(F.lit(360) * F.col("doy") / n).cast("int")
        before = F.round(F.lit(360) * (F.col("doy") - 1) / n).cast("int")
        out = df.withColumns({"_m": mapped, "_b": before}).where(F.col("_m") != F.col("_b"))
        out = out.withColumns({"doy": F.col("_m"), "calendar": F.lit("360_day")}).drop("_m", "_b")
        return with_civil_parts(out.withColumn("t", ordinal("360_day", "year", "doy").cast("int")))
    raise ValueError(f"unknown calendar {to!r}; one of {CALENDARS}")


def calendar_of(df: DataFrame) -> DataFrame:
    """The calendars present per dataset (more than one per dataset is a loading error)."""
    return df.groupBy("dataset_id").agg(F.sort_array(F.collect_set("calendar")).alias("calendars"))


def month_number(year: str | Column, month: str | Column) -> Column:
    return (_c(year) * 12 + _c(month) - 1).cast("int")


def period_number(month_no: str | Column, freq: str) -> Column:
    """Month number of the first month of the period holding ``month_no``."""
    length, first = FREQUENCIES[freq]
    m = _c(month_no)
    return (m - F.pmod(m - first, F.lit(length))).cast("int")


def month_to_date(month_no: str | Column) -> Column:
    m = _c(month_no)
    return F.make_date(F.floor(m / 12).cast("int"), (m % 12 + 1).cast("int"), F.lit(1))


def period_start(year: str | Column, month: str | Column, freq: str) -> Column:
    """First civil day of the period that holds (year, month)."""
    return month_to_date(period_number(month_number(year, month), freq))


def first_day_of_month(calendar: str | Column, month_no: str | Column) -> Column:
    """Day number ``t`` of the first day of a month in its calendar."""
    cal, m = _c(calendar), _c(month_no)
    year, month0 = F.floor(m / 12).cast("int"), (m % 12).cast("int")
    before = F.element_at(F.array(*[F.lit(d) for d in _DAYS_BEFORE_MONTH]), month0 + 1)
    return (
        F.when(cal == "360_day", year * 360 + month0 * 30)
        .when(cal == "noleap", year * 365 + before)
        .otherwise(F.datediff(month_to_date(m), F.lit("1900-01-01").cast("date")))
    )


def days_in_period(calendar: str | Column, period_no: str | Column, freq: str) -> Column:
    """Days the calendar expects in the period that begins with month ``period_no``."""
    length, _ = FREQUENCIES[freq]
    return first_day_of_month(calendar, _c(period_no) + length) - first_day_of_month(calendar, period_no)

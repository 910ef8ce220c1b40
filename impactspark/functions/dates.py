"""Date parsing and date-derived attributes (DT-1..10) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# The six accepted layouts, tried in this order (strptime
# %Y-%m-%d %H:%M:%S.%f, %Y-%m-%d %H:%M:%S, %Y-%m-%d, %d/%m/%Y %H:%M:%S.%f,
# %d/%m/%Y %H:%M:%S, %d/%m/%Y).  Single-letter fields take one or two digits
# as strptime does; the fraction takes one to six digits.
DATE_FORMATS = (
    "yyyy-M-d H:m:s.SSSSSS",
    "yyyy-M-d H:m:s",
    "yyyy-M-d",
    "d/M/yyyy H:m:s.SSSSSS",
    "d/M/yyyy H:m:s",
    "d/M/yyyy",
)

# Month-first layouts a lenient parser would still accept (trap T4).  They
# are never used silently; ``suspect_date`` flags values only they parse.
MONTH_FIRST_FORMATS = ("M/d/yyyy H:m:s", "M/d/yyyy H:m", "M/d/yyyy")

# Age bands.  Days/365 bands are right-closed at 17, 25, 35;
# calendar bands compare the PostgreSQL interval with 18, 26, 36, 51 years.
DAYS365_BANDS = ((17, "17 and below"), (25, "18-25"), (35, "26-35"))
DAYS365_TOP = "36+"
CALENDAR_BANDS = ((18, "17 and below"), (26, "18-25"), (36, "26-35"), (51, "36-50"))
CALENDAR_TOP = "Over 50"
UNKNOWN = "Unknown"


def _shape(fmt: str) -> str:
    """A regex every text the layout can parse matches: each run of pattern
    letters becomes digits (years may carry a sign), other characters stay."""
    import re
    out = []
    for run in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", fmt):
        tok = run.group(0)
        if tok[0].isalpha():
            out.append(r"[+-]?[0-9]+" if tok[0] == "y" else r"[0-9]+")
        else:
            out.append(re.escape(tok))
    return "^" + "".join(out) + "$"


def _first_parse(c: Column, formats) -> Column:
    """First layout that parses.  A failed parse costs a JVM exception, so each
    layout is only tried on text of its shape (at most one real parse per value)."""
    txt = c.cast("string")
    tries = [F.when(txt.rlike(_shape(f)), F.try_to_timestamp(txt, F.lit(f))) for f in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def parse_dates(c, formats=DATE_FORMATS, serial_dates: bool = False) -> Column:
    """DT-1: first of the accepted layouts that parses, else NULL (timestamp_ntz).

    ``serial_dates`` also reads spreadsheet day serials (days since 1899-12-30).
    """
    c = as_col(c)
    out = _first_parse(c, formats)
    if serial_dates:
        serial = F.when(c.cast("string").rlike(r"^[0-9]{5}$"),
                        F.date_add(F.lit("1899-12-30").cast("date"), c.cast("string").try_cast("int")))
        out = F.coalesce(out, serial.cast("timestamp_ntz"))
    return out


def suspect_date(c) -> Column:
    """T4: text that only a month-first layout would parse."""
    c = as_col(c)
    return parse_dates(c).isNull() & _first_parse(c, MONTH_FIRST_FORMATS).isNotNull()


def age_days365(d, dob) -> Column:
    """DT-2: whole years as elapsed days // 365."""
    return F.floor(F.datediff(F.to_date(as_col(d)), F.to_date(as_col(dob))) / 365).cast("bigint")


def band_days365(age) -> Column:
    """DT-4: right-closed bands of a DT-2 age; NULL age -> NULL."""
    a = as_col(age)
    out = F.when(a.isNull(), F.lit(None).cast("string"))
    for hi, label in DAYS365_BANDS:
        out = out.when(a <= hi, F.lit(label))
    return out.otherwise(F.lit(DAYS365_TOP))


def _age_parts(d, dob):
    d, dob = F.to_date(as_col(d)), F.to_date(as_col(dob))
    borrow = (F.dayofmonth(d) < F.dayofmonth(dob)).cast("int")
    months = (F.year(d) - F.year(dob)) * 12 + F.month(d) - F.month(dob) - borrow
    days = F.dayofmonth(d) - F.dayofmonth(dob) + borrow * F.dayofmonth(F.last_day(dob))
    return months, days


def age_calendar(d, dob) -> Column:
    """DT-3: ``EXTRACT(YEAR FROM AGE(d, dob))`` with PostgreSQL's day borrowing.

    Days are borrowed from the birth month; ``months_between`` is not used
    because it treats any two month ends as a whole number of months.
    """
    months, _ = _age_parts(d, dob)
    return F.floor(months / 12).cast("bigint")


def band_calendar(d, dob) -> Column:
    """DT-3 bands: ``AGE(d, dob) < INTERVAL 'N years'`` with 30-day months."""
    months, days = _age_parts(d, dob)
    span = months * 30 + days
    out = F.when(as_col(d).isNull() | as_col(dob).isNull(), F.lit(UNKNOWN))
    for years, label in CALENDAR_BANDS:
        out = out.when(span < years * 360, F.lit(label))
    return out.otherwise(F.lit(CALENDAR_TOP))


def month_name(d) -> Column:
    """DT-5: English month name."""
    return F.date_format(as_col(d), "MMMM")


def month_year(d) -> Column:
    """DT-5: ``'March 2026'``."""
    return F.date_format(as_col(d), "MMMM yyyy")


def month_year_padded(d) -> Column:
    """DT-6: ``TO_CHAR(d, 'Month YYYY')`` -- month blank-padded to nine characters."""
    d = as_col(d)
    return F.concat(F.rpad(F.date_format(d, "MMMM"), 9, " "), F.lit(" "), F.date_format(d, "yyyy"))


def fy_rank(d) -> Column:
    """DT-7: position of the month in an April-first year (April=1 .. March=12)."""
    return (F.pmod(F.month(as_col(d)) - 4, F.lit(12)) + 1).cast("int")


def fy_start_year(d) -> Column:
    """DT-7: the calendar year the April-first year starts in."""
    d = as_col(d)
    return (F.year(d) - (F.month(d) < 4).cast("int")).cast("int")


def month_bucket(d) -> Column:
    """DT-8: first instant of the month."""
    return F.date_trunc("month", as_col(d)).cast("timestamp_ntz")


def in_period(d, start: str, end: str, whole_last_day: bool = True) -> Column:
    """FLT-4: inclusive period.  ``whole_last_day`` keeps rows timed on the end day (T9)."""
    d = as_col(d)
    if whole_last_day:
        return F.to_date(d).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return d.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))


def covers_through(run_month: str) -> str:
    """DT-9: the last day the prior state covers -- the day before the run month.

    A driver-side constant (compare it with dates, not midnight timestamps).
    """
    import datetime as _dt
    first = _dt.date.fromisoformat(run_month[:7] + "-01")
    return (first - _dt.timedelta(days=1)).isoformat()

"""Calendar functions: local day, rolling window, month lists, ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkline.config import AGE_BAND_TOP, AGE_BANDS, UNKNOWN
from perkline.functions.text import col_


def local_day(ts: Column | str, zone: str = "Europe/Paris") -> Column:
    """Calendar day in ``zone`` of a UTC wall-clock instant."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), col_(ts)))


def utc_bounds_of_days(start: dt.date, end: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """UTC instant range that surely contains every instant whose local day
    (any zone, offsets within +/-14 h) lies in [start, end].

    Used to add a coarse, *pushable* predicate on the raw timestamp column
    next to the exact local-day predicate, so Parquet row groups outside the
    window are skipped.
    """
    lo = dt.datetime.combine(start, dt.time()) - dt.timedelta(hours=14)
    hi = dt.datetime.combine(end, dt.time()) + dt.timedelta(hours=38)
    return lo, hi


def month_start(d: Column | str) -> Column:
    return F.trunc(col_(d), "MM")


def rolling_period(as_of: Column | str, months: int = 12, include_current: bool = False) -> tuple[Column, Column]:
    """rolling window [start, end] at an as-of date (column form).

    Complete months by default: first day of (as-of month - months) to the
    day before the as-of month starts.  With ``include_current`` the window
    covers ``months`` months up to the as-of date itself.
    """
    first = month_start(as_of)
    if include_current:
        return F.add_months(first, -(months - 1)), col_(as_of).cast("date")
    return F.add_months(first, -months), F.date_sub(first, 1)


def last_n_months(as_of: Column | str, n: int = 12, include_current: bool = False) -> Column:
    """array of ``yyyy-MM`` texts of the last n months, oldest first."""
    anchor = month_start(as_of) if include_current else F.add_months(month_start(as_of), -1)
    first = F.add_months(anchor, -(n - 1))
    months = F.sequence(first, anchor, F.expr("INTERVAL 1 MONTH"))
    return F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))


def age_years(birth: Column | str, as_of: Column | str) -> Column:
    """F16: completed years between birth and as-of date.

    Year difference minus one when the birthday (month-day) has not yet
    been reached; a 29 February birthday counts as reached on 1 March.
    """
    b, d = col_(birth), col_(as_of)
    before = (F.month(d) < F.month(b)) | ((F.month(d) == F.month(b)) & (F.dayofmonth(d) < F.dayofmonth(b)))
    return F.when(b.isNotNull(), F.year(d) - F.year(b) - F.when(before, 1).otherwise(0))


def age_band(age: Column | str) -> Column:
    """Age band label, ``INCONNU`` for an unknown age."""
    a = col_(age)
    expr = F.when(a.isNull(), F.lit(UNKNOWN))
    for label, upper in AGE_BANDS:
        expr = expr.when(a <= upper, F.lit(label))
    return expr.otherwise(F.lit(AGE_BAND_TOP))


def year_month(c: Column | str) -> Column:
    """``yyyy-MM`` text of a date or instant."""
    return F.date_format(col_(c), "yyyy-MM")

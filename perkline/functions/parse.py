"""Lenient parsers of declared text (Column -> Column); invalid -> NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkline.functions.text import col_, strip_quotes

DURATION_PATTERN = r"^(\d+):(\d+):(\d+)$"


def parse_local_noon(c: Column | str, zone: str = "Europe/Paris") -> Column:
    """``d/m/yyyy`` text -> UTC instant of local noon that day.

    Accepts one- or two-digit day and month; impossible dates give NULL.
    The result is a UTC wall-clock ``timestamp_ntz``.
    """
    text = strip_quotes(c)
    day = F.try_to_timestamp(text, F.lit("d/M/yyyy")).cast("timestamp_ntz")
    local_noon = day + F.expr("INTERVAL 12 HOURS")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local_noon)


def parse_duration(c: Column | str) -> Column:
    """``H:M:S`` (any digit counts, no range check) -> seconds; what an
    integer cannot hold is invalid (NULL)."""
    text = strip_quotes(c)
    ok = text.rlike(DURATION_PATTERN)
    h, m, s = (F.regexp_extract(text, DURATION_PATTERN, i).try_cast("double") for i in (1, 2, 3))
    total = h * 3600 + m * 60 + s
    return F.when(ok & (total <= F.lit(2147483647.0)), total.cast("int"))


def parse_distance(c: Column | str) -> Column:
    """F8: km text with ``,`` or ``.`` -> metres, half-even rounding.

    Blank, non-numeric or negative input gives NULL.
    """
    text = F.replace(strip_quotes(c), F.lit(","), F.lit("."))
    km = F.when(F.length(text) > 0, text.try_cast("double"))
    # values beyond the int range cannot be stored and count as invalid
    return F.when((km >= 0) & (km * 1000 < F.lit(2147483647.0)), F.bround(km * 1000, 0).cast("int"))


def parse_int_like(c: Column | str) -> Column:
    """integer-like text (``12``, ``12.0``, ``12,7``) -> int, truncating."""
    text = F.replace(F.trim(col_(c)), F.lit(","), F.lit("."))
    num = F.when(F.length(text) > 0, text.try_cast("double"))
    finite = num.isNotNull() & ~F.isnan(num) & (F.abs(num) < F.lit(9.0e18))
    return F.when(finite, (F.floor(F.abs(num)) * F.signum(num)).cast("long"))


def parse_iso_instant(c: Column | str) -> Column:
    """ISO-8601 text with ``Z``, an offset or none (read as UTC).

    Returns the UTC wall-clock ``timestamp_ntz``; unparseable -> NULL.
    """
    text = F.trim(col_(c))
    # with the session zone pinned to UTC, text without a zone is read as
    # UTC and zoned text is shifted to UTC; the cast keeps that wall clock
    return F.when(F.length(text) > 0, F.try_to_timestamp(text).cast("timestamp_ntz"))

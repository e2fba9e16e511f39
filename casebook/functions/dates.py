"""Date functions with SQL-Server-compatible semantics, as native columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def us_week(d) -> Column:
    """Week number where week 1 holds 1 January and weeks start on Sunday.

    This is ``DATEPART(WEEK, d)`` under the default ``DATEFIRST 7``.  It is
    not the ISO week: the value runs 1..54.  ``dayofweek`` is 1 for Sunday,
    so the offset of 1 January inside its week is ``dayofweek(jan1) - 1``.
    """
    d = _c(d)
    jan1 = F.trunc(d, "year")
    return (F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7) + 1).cast("int")


def _yy(s: Column) -> Column:
    """The two-digit year field of ``d/M/yy`` text (NULL if not a number)."""
    return F.substring_index(s, "/", -1).try_cast("int")


def parse_dmy2(s, pivot_year: int = 2049) -> Column:
    """``TRY_CONVERT(date, s, 3)``: ``d/M/yy`` text to DATE, NULL on failure.

    Two-digit years follow the two-digit-year cutoff: years up to
    ``pivot_year`` are 20xx, later ones 19xx.  Spark's ``yy`` always yields
    2000-2099, so years above the pivot are moved back a century.  The
    century is read from the text's year field, so the parse itself appears
    once in the expression; a filter that Catalyst pushes down to a scan
    then parses each row once, not once per reference.
    """
    s = _c(s)
    d = F.try_to_date(s, "d/M/yy")
    shift = F.when(_yy(s) > pivot_year - 2000, -1200).otherwise(0)
    return F.add_months(d, shift)


def us_week_of_dmy2(s, pivot_year: int = 2049) -> Column:
    """``DATEPART(WEEK, TRY_CONVERT(date, s, 3))`` with a single parse.

    Same value as ``us_week(parse_dmy2(s))``; 1 January is built from the
    text's year field, so the parsed date is referenced only once.  The
    century rule is one expression of the field: with the cutoff at
    ``pivot_year``, ``(yy + 99 - pivot) % 100 + pivot_year - 99`` maps
    00..pivot to 20xx and the rest to 19xx.
    """
    s = _c(s)
    low = pivot_year - 2000
    year = (_yy(s) + (99 - low)) % 100 + (pivot_year - 99)
    jan1 = F.make_date(year, F.lit(1), F.lit(1))
    d = parse_dmy2(s, pivot_year)
    return (F.floor((F.datediff(d, jan1) + F.dayofweek(jan1) - 1) / 7) + 1).cast("int")


def month_name(d) -> Column:
    """``DATENAME(MONTH, d)`` (English month name)."""
    return F.date_format(_c(d), "MMMM")


def weekday_name(d) -> Column:
    """``DATENAME(WEEKDAY, d)`` (English day name)."""
    return F.date_format(_c(d), "EEEE")


def year_month(ts) -> Column:
    """``CONVERT(CHAR(7), ts, 120)``: ``yyyy-MM`` text."""
    return F.date_format(_c(ts), "yyyy-MM")


def days_between(start, end) -> Column:
    """``DATEDIFF(DAY, start, end)``: day boundaries crossed, on dates."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))

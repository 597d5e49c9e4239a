"""Parsing of text amounts, dates and coordinates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
WHOLE = "decimal(38,0)"
# Exact to the precision of a double for any coordinate in degrees or metres.
COORDINATE = "decimal(30,15)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_point(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit("."))


def parse_amount(c: Column | str, scale0: bool = False) -> Column:
    """Strict parse of a decimal-comma amount; malformed text raises.

    ``scale0`` keeps whole units only, rounded half away from zero.
    """
    return decimal_point(c).cast(WHOLE if scale0 else MONEY)


def try_parse_amount(c: Column | str, scale0: bool = False) -> Column:
    """Tolerant form of :func:`parse_amount`; malformed text is NULL."""
    return decimal_point(c).try_cast(WHOLE if scale0 else MONEY)


def try_parse_coordinate(c: Column | str, scale0: bool = False) -> Column:
    """Finite decimal notation only: ``NaN``, ``Infinity`` or ``1d`` would be doubles as well."""
    return decimal_point(c).try_cast(WHOLE if scale0 else COORDINATE).cast("double")


def try_parse_count(c: Column | str) -> Column:
    """Tolerant whole number; fractions are rounded."""
    return _col(c).try_cast(WHOLE).try_cast("int")


def parse_french_date(c: Column | str) -> Column:
    """Strict ``DD/MM/YYYY``; malformed text raises."""
    return F.to_date(_col(c), "dd/MM/yyyy")


def period(year: int, quarter: int | None = None) -> tuple[dt.date, dt.date]:
    """First day of a year or a quarter of it, and the first day after."""
    first, months = (1, 12) if quarter is None else (3 * quarter - 2, 3)
    end = dt.date(year + (first + months > 12), (first + months - 1) % 12 + 1, 1)
    return dt.date(year, first, 1), end


def in_period(date: Column | str, year: int | None = None, quarter: int | None = None) -> Column:
    """Date within a year, a quarter of a year, or that quarter of any year.

    A year is tested as a range of dates, which the Parquet reader can skip by.
    """
    date = _col(date)
    if year is None:
        return F.lit(True) if quarter is None else F.quarter(date) == quarter
    start, end = period(year, quarter)
    return (date >= F.lit(start)) & (date < F.lit(end))


def price_per_m2(price: Column | str, surface: Column | str) -> Column:
    """Double-precision price per square metre, NULL for a zero or missing surface."""
    surface = _col(surface).cast("double")
    return _col(price).cast("double") / F.nullif(surface, F.lit(0.0))

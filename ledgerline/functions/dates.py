"""Month arithmetic and null handling shared by all panel operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_number(d: Column) -> Column:
    return 12 * F.year(d) + F.month(d)


def months_between(later: Column, earlier: Column) -> Column:
    """Calendar months from one date to another, days ignored."""
    return month_number(later) - month_number(earlier)


def add_months(d: Column, n: Column | int) -> Column:
    """The month end `n` months from the month of a date."""
    return F.last_day(F.add_months(F.last_day(d), n))


def finite(x: Column) -> Column:
    """Null in place of NaN and infinities: the engine stores neither."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)


def log_of(x: Column) -> Column:
    return F.when(x > 0, F.log(x))


def two_digit_year(day_month_year: Column) -> Column:
    """Date from dd/mm/yy; years from 69 on are of the last century."""
    year = F.regexp_extract(day_month_year, r"^\d{2}/\d{2}/(\d{2})$", 1)
    full = F.when(year >= "69", F.concat(F.lit("19"), year)).otherwise(F.concat(F.lit("20"), year))
    return F.try_to_date(F.concat(F.substring(day_month_year, 1, 6), full), "dd/MM/yyyy")

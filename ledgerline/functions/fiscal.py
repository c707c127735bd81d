"""Fiscal years and return periods (P-18, P-21, P-22)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

START = 4


def start_year(day: Column, start: int = START) -> Column:
    return F.year(F.add_months(day, 1 - start))


def label(day: Column, start: int = START) -> Column:
    """2024-06-30 -> 2024-25."""
    y = start_year(day, start)
    return F.format_string("%04d-%02d", y, F.pmod(y + 1, F.lit(100)))


def straddles(first: Column, last: Column, start: int = START) -> Column:
    """Whether a period lies in more than one fiscal year."""
    return start_year(first, start) != start_year(last, start)


def bounds(text: Column, start: int = START) -> tuple[Column, Column]:
    """First and last day of a year named like 'FY 2024-25' or '2024-2025'; null unless the years follow each other."""
    shape = r"(\d{4})\s*-\s*(\d{4}|\d{2})(?!\d)"
    first = F.nullif(F.regexp_extract(text, shape, 1), F.lit("")).cast("int")
    second = F.nullif(F.regexp_extract(text, shape, 2), F.lit("")).cast("int")
    good = F.pmod(first + 1, F.lit(100)) == F.pmod(second, F.lit(100))
    low = F.when(good, F.make_date(first, F.lit(start), F.lit(1)))
    return low, F.date_sub(F.add_months(low, 12), 1)


def containing(day: Column, start: int = START) -> tuple[Column, Column]:
    low = F.make_date(start_year(day, start), F.lit(start), F.lit(1))
    return low, F.date_sub(F.add_months(low, 12), 1)


def return_period(day: Column) -> Column:
    """MMyyyy, as portal returns name their month."""
    return F.date_format(day, "MMyyyy")

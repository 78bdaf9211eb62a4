"""Natural keys of the warehouse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a season starts on the first of July.
SEASON_MONTH = 7


def name_key(name: Column) -> Column:
    return F.upper(name)


def plain_name(name: Column) -> Column:
    """A name without regard to case, commas and the width of its gaps, for comparisons only."""
    return F.trim(F.regexp_replace(F.lower(F.translate(name, ",", " ")), r"\s+", " "))


def calendar_key(start: Column) -> Column:
    """The day as an int ``yyyyMMdd``. Date parts keep it free of text formatting."""
    day = F.to_date(start)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def season_start_year(start: Column, first_month: int = SEASON_MONTH) -> Column:
    """Stepping back ``first_month - 1`` months makes every season one calendar year."""
    return F.year(F.add_months(F.to_date(start), 1 - first_month))


def season_key(start_year: Column) -> Column:
    """``2024/2025`` from the year a season starts in."""
    return F.concat(start_year.cast("string"), F.lit("/"), (start_year + 1).cast("string"))


def season_start(start_year: Column, first_month: int = SEASON_MONTH) -> Column:
    return F.make_date(start_year, F.lit(first_month), F.lit(1))


def season_end(start_year: Column, first_month: int = SEASON_MONTH) -> Column:
    return F.date_sub(season_start(start_year + 1, first_month), 1)

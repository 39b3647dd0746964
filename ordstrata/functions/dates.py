"""Date parsing and parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordstrata.functions.text import trim_ws

_DAY_MONTH_YEAR = "d/M/yyyy"


def parse_dmy(text: Column) -> Column:
    """``dd/mm/yyyy`` to a date; text that is no date fails the job (ANSI mode)."""
    return F.to_date(trim_ws(text), _DAY_MONTH_YEAR)


def try_parse_dmy(text: Column) -> Column:
    """``dd/mm/yyyy`` to a date; text that is no date, such as 31/04/2020, gives NULL."""
    return F.try_to_date(trim_ws(text), _DAY_MONTH_YEAR)


def years_crossed(later: Column, earlier: Column) -> Column:
    """New Years between two dates, not completed years: 31 Dec to 1 Jan counts 1."""
    return (F.year(later) - F.year(earlier)).cast("bigint")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def year_of(date: Column) -> Column:
    return F.year(date).cast("bigint")


def month_of(date: Column) -> Column:
    return F.month(date).cast("bigint")


def half_of_month(month: Column) -> Column:
    """1 for January to June, else 2 (also for NULL)."""
    return F.when(month <= 6, F.lit(1)).otherwise(F.lit(2)).cast("bigint")


def weekday_number(date: Column) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(date).cast("bigint")


def weekday_name(date: Column) -> Column:
    """English name of the weekday."""
    return F.date_format(date, "EEEE")

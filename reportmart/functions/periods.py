"""Expressions over ``yyyyMM`` period strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PERIOD_PATTERN = "^[0-9]{6}$"


def period_year(period: Column) -> Column:
    return F.substring(period, 1, 4).try_cast("int")


def period_month(period: Column) -> Column:
    return F.substring(period, 5, 2).try_cast("int")


def month_index(period: Column) -> Column:
    """Months since year 0, so that December and January are neighbours."""
    return period_year(period) * 12 + period_month(period) - 1


def quarter_label(month: Column) -> Column:
    """``Q1``..``Q4``; out-of-range months fall into the nearest quarter, an unknown one into Q4."""
    number = F.ceil(F.coalesce(month, F.lit(12)) / 3)
    return F.concat(F.lit("Q"), F.greatest(F.least(number, F.lit(4)), F.lit(1)).cast("string"))


def year_month(period: Column) -> Column:
    """``yyyyMM`` as ``yyyy-MM``."""
    return F.concat_ws("-", F.substring(period, 1, 4), F.substring(period, 5, 2))


def period_of_year_month(value: Column) -> Column:
    """``yyyy-MM`` back to ``yyyyMM``."""
    return F.replace(value, F.lit("-"), F.lit(""))


def period_end(period: Column) -> Column:
    """Last day of the month; null for an impossible month."""
    first = F.concat_ws("-", F.substring(period, 1, 4), F.substring(period, 5, 2), F.lit("01"))
    return F.when(period.rlike(PERIOD_PATTERN), F.last_day(first.try_cast("date")))

"""Expressions over reported values, which stay text until they are typed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_blank(text: Column) -> Column:
    """Null or nothing but spaces."""
    return F.coalesce(F.trim(text) == "", F.lit(True))


def is_absent(text: Column) -> Column:
    """Null or the empty string."""
    return F.coalesce(text == "", F.lit(True))


def is_explicit_zero(text: Column) -> Column:
    """True for the text ``0`` only; never null."""
    return text.eqNullSafe("0")


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """``part`` in percent of ``whole``; null when ``whole`` is null or 0."""
    share = F.try_divide(part, whole) * 100
    return share if digits is None else F.round(share, digits)


def change_percent(current: Column, previous: Column, digits: int | None = 2) -> Column:
    """Growth over ``previous`` in percent; null when ``previous`` is null or 0."""
    return percent(current - previous, previous, digits)

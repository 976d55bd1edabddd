"""Column expressions used by the operators."""

from .instants import parse_instant, submitted_at
from .keys import natural_key
from .periods import (
    PERIOD_PATTERN,
    month_index,
    period_end,
    period_month,
    period_of_year_month,
    period_year,
    quarter_label,
    year_month,
)
from .values import change_percent, is_absent, is_blank, is_explicit_zero, percent

__all__ = [
    "PERIOD_PATTERN",
    "change_percent",
    "is_absent",
    "is_blank",
    "is_explicit_zero",
    "month_index",
    "natural_key",
    "parse_instant",
    "percent",
    "period_end",
    "period_month",
    "period_of_year_month",
    "period_year",
    "quarter_label",
    "submitted_at",
    "year_month",
]

"""Column expressions shared by the operators."""

from .dates import (
    DATE_FORMATS,
    date_to_period,
    parse_date,
    period_end,
    period_start,
    period_step,
    period_to_date,
    year_quarter,
)
from .numbers import clamp, decimal_comma, null_if_nan, percent_of, rounded, to_number

__all__ = [
    "DATE_FORMATS",
    "clamp",
    "date_to_period",
    "decimal_comma",
    "null_if_nan",
    "parse_date",
    "percent_of",
    "period_end",
    "period_start",
    "period_step",
    "period_to_date",
    "rounded",
    "to_number",
    "year_quarter",
]

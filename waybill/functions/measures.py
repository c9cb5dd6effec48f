"""Ratios, percentages and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_pct(num: Column, den: Column, scale: int = 2) -> Column:
    """``num / den`` as a rounded percentage, NULL when the denominator is zero or NULL."""
    return F.round(F.try_divide(num, den) * 100, scale)


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true; NULL counts as false."""
    return F.count_if(cond)


def _text(pattern: str, c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string(pattern, c))


def thousands(c: Column) -> Column:
    return _text("%,d", c.cast("long"))


def percent_text(c: Column) -> Column:
    return _text("%.2f%%", c.cast("double"))


def signed_text(c: Column) -> Column:
    return _text("%+.2f", c.cast("double"))


def clock_hour_text(c: Column) -> Column:
    return _text("%02d:00", c.cast("long"))


DISPLAY = {
    "thousands": thousands,
    "percent": percent_text,
    "signed": signed_text,
    "clock_hour": clock_hour_text,
}

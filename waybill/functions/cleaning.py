"""Text to typed values. Every parser yields NULL for text it cannot read, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts a CSV reader of the pandas family takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
_FRACTION = r"(:\d{1,2})\.\d+$"
_STAMP = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2})?)?$"
_CLOCK = r"^\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_WHOLE = r"^[+-]?\d+(\.0*)?$"


def blank_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_TOKENS), c)


def parse_timestamp(c: Column) -> Column:
    """Day-first (``d/M/yyyy``) or ISO text to ``timestamp_ntz`` at whole seconds, decided per row.

    A year alone, a year of other than four digits, and a time with an offset are unreadable.
    """
    text = F.trim(c)
    text = F.when(text.contains("/"), F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1")).otherwise(text)
    text = F.when(text.contains("."), F.regexp_replace(text, _FRACTION, "$1")).otherwise(text)
    return F.when(text.rlike(_STAMP), text.try_cast("timestamp_ntz"))


def parse_date(c: Column) -> Column:
    return parse_timestamp(c).cast("date")


def complete_time(c: Column) -> Column:
    """Trim; ``HH:MM`` gets its seconds."""
    t = F.trim(c)
    return F.when(F.size(F.split(t, ":")) == 2, F.concat(t, F.lit(":00"))).otherwise(t)


def time_on_date(date: Column, time_text: Column) -> Column:
    """A clock time placed on a calendar date."""
    stamped = F.concat(date.cast("string"), F.lit(" "), complete_time(time_text))
    return F.when(F.trim(time_text).rlike(_CLOCK), stamped.try_cast("timestamp_ntz"))


def parse_double(c: Column) -> Column:
    """Finite decimal numbers; type suffixes, ``Infinity`` and values beyond a double are unreadable."""
    text = F.trim(c)
    value = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def parse_long(c: Column) -> Column:
    """Whole numbers, also when written as ``3.0`` or ``1e3``; a fraction is unreadable.

    Digits never pass through a double.
    """
    text = F.trim(c)
    plain = F.regexp_replace(text, r"\.0*$", "").try_cast("long")
    value = F.when(text.rlike(_NUMBER), text.try_cast("decimal(38,10)"))
    scaled = F.when(text.rlike("[eE]") & (value == F.floor(value)), value.try_cast("long"))
    return F.when(text.rlike(_WHOLE), plain).otherwise(scaled)


def iso_date(c: Column) -> Column:
    return c.cast("date").cast("string")


def iso_timestamp(c: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` text of an NTZ timestamp."""
    return F.substring(c.cast("string"), 1, 19)


def digit_pattern(c: Column) -> Column:
    """Shape of a text value: every digit becomes ``N``."""
    return F.regexp_replace(c.cast("string"), "[0-9]", "N")

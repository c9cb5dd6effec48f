"""Hours, durations and fixed-offset shifts on ``timestamp_ntz`` columns.

``timestampdiff``, ``date_format`` and ``date_trunc`` move NTZ values through the session time zone
(a zone with daylight saving then changes the result), so durations here are NTZ subtraction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def hour_of(ts: Column) -> Column:
    return F.hour(ts).cast("long")


def shift_hour(hour: Column, offset_hours: Column) -> Column:
    """Hour of day after a whole-hour shift: the same as taking the hour of the shifted timestamp."""
    return F.pmod(hour + offset_hours, F.lit(24)).cast("long")


def shift_timestamp(ts: Column, offset_hours: Column) -> Column:
    return F.timestamp_add("HOUR", offset_hours.cast("int"), ts)


def local_hour(ts: Column, offset_hours: Column) -> Column:
    return shift_hour(hour_of(ts), offset_hours)


def whole_minutes(start: Column, end: Column) -> Column:
    """Elapsed minutes cut towards zero."""
    return (end - start).cast("interval minute").cast("long")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, for bucketing."""
    return (ts - F.expr(_EPOCH)).cast("interval second").cast("long")


def hour_mismatch(logged: Column, ts: Column) -> Column:
    """Logged hour differs from the hour of the timestamp (either one NULL: not a mismatch)."""
    return logged != hour_of(ts)


def hour_truncated(logged: Column, true_hour: Column, late_from: int = 20) -> Column:
    """Logged hour was cut to zero although the event is late in the evening."""
    return (logged == 0) & (true_hour >= late_from)

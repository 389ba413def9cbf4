"""Time expressions: hour of day, epoch conversions and trip durations.

Timestamps can arrive as TIMESTAMP (session-zone, e.g. from CSV) or as
TIMESTAMP_NTZ (Parquet written without a zone). ``unix_timestamp`` treats
both correctly; sub-second epochs differ, so the millisecond helpers take the
column's type into account.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "1970-01-01 00:00:00"


def is_ntz(df: DataFrame, column: str) -> bool:
    """True when ``df[column]`` is a TIMESTAMP_NTZ column."""
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def hour_of_day(ts: Column) -> Column:
    """Hour of the wall-clock time as an INT 0-23.

    Grouping on this integer and formatting with :func:`hour_label` after the
    aggregation gives the same groups as ``substr(cast(ts as string), 12, 2)``
    while hashing ints instead of strings in the hot path.
    """
    return F.hour(ts)


def hour_label(hour: Column) -> Column:
    """Two-digit label ``'00'``..``'23'`` for an hour integer."""
    return F.lpad(hour.cast("string"), 2, "0")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, fraction dropped (``unix_timestamp``)."""
    return F.unix_timestamp(ts)


def epoch_micros(ts: Column, ntz: bool) -> Column:
    """Microseconds since the epoch; for NTZ the wall clock is read as UTC."""
    if ntz:
        return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast(T.TimestampNTZType()), ts)
    return F.unix_micros(ts)


def epoch_millis(ts: Column, ntz: bool) -> Column:
    """Milliseconds since the epoch, floored (like ``java.util.Date.getTime``)."""
    return F.floor(epoch_micros(ts, ntz) / F.lit(1000)).cast("long")


def duration_seconds(start: Column, end: Column) -> Column:
    """``unix_timestamp(end) - unix_timestamp(start)`` as LONG seconds."""
    return epoch_seconds(end) - epoch_seconds(start)


def duration_millis(start: Column, end: Column, ntz: bool) -> Column:
    """Difference of the two floored millisecond epochs, as LONG."""
    return epoch_millis(end, ntz) - epoch_millis(start, ntz)

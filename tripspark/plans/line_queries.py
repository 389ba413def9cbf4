"""Q1 and Q2 computed straight from raw comma-separated lines.

This is the text-in flavour of the questions: fields are read by position
from each line and only the fields a question needs are parsed. Keys stay
strings (trip ids are joined as text, vendors are ordered as text), the hour
is two characters of the raw start field, and timestamps are parsed from their
first 19 characters with a pattern without fraction — trailing text such as a
fraction of a second is ignored, so durations are in whole seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.operators import aggregates
from tripspark.sources.text import extract_start_hour, extract_trip_id, extract_vendor_id, line_field

# Fixed value: the timestamp pattern applied to the first 19 characters.
LINE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_prefix_timestamp(token: Column, strict: bool = True) -> Column:
    """Parse the leading ``yyyy-MM-dd HH:mm:ss`` of ``token``; in strict mode a
    token that does not parse fails the task (whatever the ANSI setting)."""
    parsed = F.try_to_timestamp(F.substring(token, 1, 19), F.lit(LINE_TIMESTAMP_FORMAT))
    if not strict:
        return parsed
    msg = F.concat(F.lit("cannot parse timestamp from '"), F.coalesce(token, F.lit("")), F.lit("'"))
    return F.when(parsed.isNull(), F.raise_error(msg).cast("timestamp")).otherwise(parsed)


def _strict_double(token: Column, strict: bool) -> Column:
    parsed = token.try_cast("double")
    if not strict:
        return parsed
    msg = F.concat(F.lit("cannot parse number from '"), F.coalesce(token, F.lit("")), F.lit("'"))
    return F.when(parsed.isNull(), F.raise_error(msg).cast("double")).otherwise(parsed)


def avg_duration_by_hour_from_lines(
    lines: DataFrame, *, sep: str = ",", scale: float = 1000.0, strict: bool = True
) -> DataFrame:
    """``HourOfDay`` (raw text), ``AverageTripDuration``: every line counts,
    zero and negative durations included; ordered by the hour text."""
    value = F.col("value")
    start = parse_prefix_timestamp(line_field(value, 1, sep), strict)
    end = parse_prefix_timestamp(line_field(value, 2, sep), strict)
    return aggregates.avg_duration_by_bucket(
        lines,
        extract_start_hour(value, sep),
        start,
        end,
        require_positive=False,
        scale=scale,
        key_alias="HourOfDay",
        value_alias="AverageTripDuration",
        label=lambda c: c,
        # strict parsing validates the start field, so at most 24 hours (+ NULL);
        # tolerant parsing could let malformed text form other groups
        max_buckets=25 if strict else None,
    )


def max_cost_by_vendor_from_lines(
    trip_lines: DataFrame, vendor_lines: DataFrame, *, sep: str = ",", strict: bool = True
) -> DataFrame:
    """``VendorId`` (text), ``MaxTripCost`` over trips ⋈ vendors joined on the
    trip id *text*; ordered by vendor text."""
    value = F.col("value")
    costs = trip_lines.select(
        extract_trip_id(value, sep).alias("trip"), _strict_double(line_field(value, 7, sep), strict).alias("cost")
    )
    pairs = vendor_lines.select(extract_trip_id(value, sep).alias("trip"), extract_vendor_id(value, sep).alias("vendor"))
    return aggregates.max_by_dimension(
        costs, pairs, fact_key="trip", dim_key="trip", value="cost", attribute="vendor",
        key_alias="VendorId", value_alias="MaxTripCost",
    )


"""Grouped aggregates.

Both aggregates are algebraic, so Spark runs a partial (map-side) aggregate
before the exchange: a hot group — even one holding a third of all rows —
is collapsed inside each input task and never lands whole on one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.functions.time import duration_seconds, hour_label, hour_of_day
from tripspark.operators.joins import reduced_by_keys
from tripspark.schemas import TRIPS, VENDORS, TripRoles, VendorRoles


def avg_duration_by_bucket(
    df: DataFrame,
    bucket: Column,
    start: Column,
    end: Column,
    *,
    require_positive: bool = True,
    scale: float = 1000.0,
    key_alias: str = "bucket",
    value_alias: str = "avg_duration",
    label=hour_label,
    order: bool = True,
    max_buckets: int | None = None,
) -> DataFrame:
    """Mean of ``(unix_timestamp(end) - unix_timestamp(start)) / scale`` per bucket.

    The mean is computed as ``sum(whole seconds) / count / scale``: the sum is
    an exact LONG, so the result does not depend on the order in which
    partial sums are combined. ``require_positive`` drops trips with
    ``end <= start``; without it zero and negative durations enter the mean.
    ``bucket`` should be a cheap (integer) expression; ``label`` turns it into
    the output key after the aggregation, i.e. on one row per group.
    ``max_buckets``: a proven bound on the number of groups (24 hours, 12
    months). The few result rows are then sorted in one partition after a
    tiny exchange, instead of a range-partitioned sort with its sampling job;
    without a bound the global ``orderBy`` is used.
    """
    if require_positive:
        df = df.where(end > start)
    per_bucket = (
        df.select(bucket.alias("_bucket"), duration_seconds(start, end).alias("_secs"))
        .groupBy("_bucket")
        .agg(F.sum("_secs").alias("_sum"), F.count("_secs").alias("_n"))
    )
    mean = F.try_divide(F.col("_sum").cast("double"), F.col("_n").cast("double")) / F.lit(float(scale))
    out = per_bucket.select(label(F.col("_bucket")).alias(key_alias), mean.alias(value_alias))
    if not order:
        return out
    if max_buckets is not None:
        return out.repartition(1).sortWithinPartitions(key_alias)
    return out.orderBy(key_alias)


def avg_duration_by_hour(
    trips: DataFrame,
    roles: TripRoles = TRIPS,
    *,
    require_positive: bool = True,
    scale: float = 1000.0,
    key_alias: str = "HourOfDay",
    value_alias: str = "AverageTripDuration",
    order: bool = True,
) -> DataFrame:
    """Average trip duration per start hour (two-digit string key)."""
    start, end = F.col(roles.start), F.col(roles.end)
    return avg_duration_by_bucket(
        trips,
        hour_of_day(start),
        start,
        end,
        require_positive=require_positive,
        scale=scale,
        key_alias=key_alias,
        value_alias=value_alias,
        order=order,
        max_buckets=25,  # hours 0-23 plus NULL
    )


def max_by_dimension(
    facts: DataFrame,
    dims: DataFrame,
    *,
    fact_key: str,
    dim_key: str,
    value: str,
    attribute: str,
    key_alias: str,
    value_alias: str,
    key_type: str | None = None,
    preaggregate: bool = False,
    reduce_dims: bool = False,
    order: bool = True,
) -> DataFrame:
    """``max(facts.value)`` per ``dims.attribute`` over ``facts ⋈ dims`` (inner).

    Inner-join bag semantics are kept (unmatched facts drop out, a fact with
    two dimension rows counts for both attributes). The plan is one shuffled
    join below a partial aggregate, in which adaptive execution splits a key
    that is hot on either side. ``preaggregate`` first reduces the facts to one
    row per key, which ``max`` allows: the caller's choice where fact keys
    repeat and the dimension has one row per key (an aggregated side can't be
    split by skew handling). ``reduce_dims`` drops dimension rows that no fact can
    match before the join shuffles them (:func:`joins.reduced_by_keys`), for facts that
    a selective filter left. ``key_type`` casts the output key (e.g.
    ``"string"`` for text ordering).
    """
    f = facts.select(F.col(fact_key).alias("_k"), F.col(value).alias("_v"))
    if preaggregate:
        f = f.groupBy("_k").agg(F.max("_v").alias("_v"))
    d = dims.select(F.col(dim_key).alias("_k"), F.col(attribute).alias("_a"))
    if reduce_dims:
        d = reduced_by_keys(d, facts, "_k", fact_key)
    joined = f.join(d, "_k", "inner")
    per_attr = joined.groupBy("_a").agg(F.max("_v").alias(value_alias))
    key = F.col("_a") if key_type is None else F.col("_a").cast(key_type)
    out = per_attr.select(key.alias(key_alias), F.col(value_alias))
    return out.orderBy(key_alias) if order else out


def max_cost_by_vendor(
    trips: DataFrame,
    vendors: DataFrame,
    roles: TripRoles = TRIPS,
    vroles: VendorRoles = VENDORS,
    *,
    key_alias: str = "VendorId",
    value_alias: str = "MaxTripCost",
    key_type: str | None = None,
    preaggregate: bool = False,
    reduce_dims: bool = False,
    order: bool = True,
) -> DataFrame:
    """Maximum trip cost per vendor (inner join trips ⋈ vendors on the trip id)."""
    return max_by_dimension(
        trips,
        vendors,
        fact_key=roles.id,
        dim_key=vroles.id,
        value=roles.cost,
        attribute=vroles.vendor,
        key_alias=key_alias,
        value_alias=value_alias,
        key_type=key_type,
        preaggregate=preaggregate,
        reduce_dims=reduce_dims,
        order=order,
    )

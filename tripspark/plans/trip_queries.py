"""The three trip questions, as DataFrame plans.

Each question exists in two flavours whose semantics differ in small, named
ways (``variant="dataframe"`` is the default; ``variant="rdd"`` reproduces the
record-at-a-time program's rules). The differences are flags of the shared
operators, not separate code paths:

=================  ==========================  =============================
question           ``dataframe``               ``rdd``
=================  ==========================  =============================
Q1 rows            ``end > start`` only        all rows (≤ 0 durations count)
Q2 vendor key      INT, numeric order          STRING, text order
Q3 date cut        ``start >= cutoff``         ``end > cutoff``
Q3 moved check     both axes must differ       none
Q3 domain guard    ``0 <= a <= 1``             none (``a > 1`` → NaN speed)
Q3 duration        whole seconds (LONG)        milliseconds / 1000 (DOUBLE)
Q3 zero duration   NULL speed                  IEEE (Infinity / NaN)
Q3 output          vendor, id, speed,          speed, vendor (LONG)
                   distance, duration
=================  ==========================  =============================
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.functions.geo import EARTH_RADIUS
from tripspark.operators import aggregates, filters, metrics, topk
from tripspark.schemas import TRIPS, VENDORS, TripRoles, VendorRoles

# The trip id of the lookup, the Q3 date cut and k.
LOOKUP_TRIP_ID = 249108525463
DEFAULT_CUTOFF = "2015-03-10 00:00:00"
DEFAULT_K = 5

VARIANTS = ("dataframe", "rdd")


def _check(variant: str) -> None:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, got {variant!r}")


def lookup_trip(trips: DataFrame, trip_id: int = LOOKUP_TRIP_ID, roles: TripRoles = TRIPS) -> DataFrame:
    """All columns of the trip(s) with the given id."""
    return filters.point_lookup(trips, roles.id, trip_id)


def avg_trip_duration_per_hour(
    trips: DataFrame, *, variant: str = "dataframe", roles: TripRoles = TRIPS, scale: float = 1000.0
) -> DataFrame:
    """Q1 — ``HourOfDay`` (``'00'``-``'23'``), ``AverageTripDuration`` in
    seconds / ``scale`` (1000 by default; 60 gives minutes), ordered by hour."""
    _check(variant)
    return aggregates.avg_duration_by_hour(
        trips, roles, require_positive=(variant == "dataframe"), scale=scale
    )


def max_trip_cost_per_vendor(
    trips: DataFrame,
    vendors: DataFrame,
    *,
    variant: str = "dataframe",
    roles: TripRoles = TRIPS,
    vroles: VendorRoles = VENDORS,
) -> DataFrame:
    """Q2 — ``VendorId``, ``MaxTripCost`` over trips ⋈ vendors, ordered by vendor."""
    _check(variant)
    return aggregates.max_cost_by_vendor(
        trips, vendors, roles, vroles, key_type=("string" if variant == "rdd" else None)
    )


def clean_trips(
    trips: DataFrame,
    *,
    variant: str = "dataframe",
    cutoff: str = DEFAULT_CUTOFF,
    roles: TripRoles = TRIPS,
) -> DataFrame:
    """Q3's row filters: coordinate rules, ``end > start`` and the date cut."""
    _check(variant)
    df = filters.valid_coordinates(trips, roles, require_nonzero=True, require_moved=(variant == "dataframe"))
    df = filters.positive_duration(df, roles)
    if variant == "dataframe":
        return filters.after_cutoff(df, roles.start, cutoff, inclusive=True)
    return filters.after_cutoff(df, roles.end, cutoff, inclusive=False)


def parsed_trips(
    trips: DataFrame,
    *,
    variant: str = "dataframe",
    cutoff: str = DEFAULT_CUTOFF,
    radius: float = EARTH_RADIUS,
    roles: TripRoles = TRIPS,
) -> DataFrame:
    """Cleaned trips with the metric columns (duration, a, c, distance, speed)."""
    df = clean_trips(trips, variant=variant, cutoff=cutoff, roles=roles)
    if variant == "dataframe":
        return metrics.trip_metrics(df, roles, precision="s", guard_domain=True, radius=radius)
    return metrics.trip_metrics(
        df, roles, precision="ms", guard_domain=False, radius=radius, zero_division="ieee"
    )


def fastest_trips(
    trips: DataFrame,
    vendors: DataFrame,
    *,
    variant: str = "dataframe",
    k: int = DEFAULT_K,
    cutoff: str = DEFAULT_CUTOFF,
    radius: float = EARTH_RADIUS,
    method: str = "candidates",
    roles: TripRoles = TRIPS,
    vroles: VendorRoles = VENDORS,
) -> DataFrame:
    """Q3 — the ``k`` fastest cleaned trips with their vendor.

    Ordered by speed descending (NULL last, NaN first), ties broken by trip id
    then vendor. ``method="candidates"`` (default) avoids shuffling either
    table; ``method="join"`` shuffles both, each cut to its top k rows per
    trip id first. Both are exact (:func:`topk.top_k_join`).
    """
    parsed = parsed_trips(trips, variant=variant, cutoff=cutoff, radius=radius, roles=roles)
    facts = parsed.select(
        F.col(roles.id).alias("_id"),
        F.col(metrics.SPEED).alias("_speed"),
        F.col(metrics.DISTANCE).alias("_dist"),
        F.col(metrics.DURATION).alias("_dur"),
    )
    dims = vendors.select(F.col(vroles.id).alias("_id"), F.col(vroles.vendor).alias("_vendor"))
    if method not in ("candidates", "join"):
        raise ValueError(f"method must be 'candidates' or 'join', got {method!r}")
    top = topk.top_k_join(
        facts,
        dims,
        key="_id",
        score="_speed",
        k=k,
        fact_cols=["_dist", "_dur"],
        dim_cols=["_vendor"],
        method="candidates" if method == "candidates" else "shuffle",
    )
    if variant == "dataframe":
        return top.select(
            F.col("_vendor").alias("VendorCompanyId"),
            F.col("_id").alias("TripId"),
            F.col("_speed").alias("SpeedInMetersPerSec"),
            F.col("_dist").alias("DistanceInMeters"),
            F.col("_dur").alias("DurationInSec"),
        )
    return top.select(
        F.col("_speed").alias("SpeedInMetersPerSec"), F.col("_vendor").cast("long").alias("VendorCompanyId")
    )

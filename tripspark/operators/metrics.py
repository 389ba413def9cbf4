"""Per-trip derived metrics: duration, haversine terms, distance, speed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.functions.geo import EARTH_RADIUS, central_angle, haversine_a, speed
from tripspark.functions.time import duration_millis, duration_seconds, is_ntz
from tripspark.schemas import TRIPS, TripRoles

# Output column names of the metric chain.
DURATION = "durationInSec"
HAVERSINE_A = "a"
CENTRAL_ANGLE = "c"
DISTANCE = "distanceInMeters"
SPEED = "speedMetersPerSec"


def trip_metrics(
    trips: DataFrame,
    roles: TripRoles = TRIPS,
    *,
    precision: str = "s",
    guard_domain: bool = True,
    radius: float = EARTH_RADIUS,
    zero_division: str = "null",
) -> DataFrame:
    """Add ``durationInSec``, ``a``, ``c``, ``distanceInMeters`` and
    ``speedMetersPerSec`` to every trip.

    * ``precision="s"``: whole-second LONG duration (``unix_timestamp`` difference);
      ``"ms"``: difference of millisecond epochs divided by 1000.0 (DOUBLE).
    * ``guard_domain``: keep only ``0 <= a <= 1`` (drops NaN), so the square
      roots are defined; without it ``a > 1`` yields NaN distances and speeds.
    * ``radius``: 6371.0 gives kilometres (the column names say metres; pass
      6371000.0 for real metres).
    * ``zero_division``: see :func:`tripspark.functions.geo.speed`.
    All five columns are added in one projection (one codegen stage).
    """
    start, end = F.col(roles.start), F.col(roles.end)
    if precision == "s":
        duration = duration_seconds(start, end)
    elif precision == "ms":
        duration = duration_millis(start, end, is_ntz(trips, roles.start)) / F.lit(1000.0)
    else:
        raise ValueError(f"precision must be 's' or 'ms', got {precision!r}")
    slon, slat, elon, elat = (F.col(c) for c in roles.coordinates)
    df = trips.withColumns(
        {DURATION: duration, HAVERSINE_A: haversine_a(slon, elon, slat, elat)}
    )
    if guard_domain:
        df = df.where((F.col(HAVERSINE_A) <= F.lit(1.0)) & (F.col(HAVERSINE_A) >= F.lit(0.0)))
    return df.withColumns(
        {
            CENTRAL_ANGLE: central_angle(F.col(HAVERSINE_A)),
            DISTANCE: central_angle(F.col(HAVERSINE_A)) * F.lit(float(radius)),
        }
    ).withColumn(SPEED, speed(F.col(DISTANCE), F.col(DURATION), zero_division))

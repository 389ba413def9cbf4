"""Great-circle geometry as Column expressions (haversine formula)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the sphere radius used for distances (6371, i.e. kilometres;
# pass 6371000.0 for metres).
EARTH_RADIUS = 6371.0


def half_chord(angle: Column) -> Column:
    """hav(θ) = sin²(θ / 2)."""
    return F.pow(F.sin(angle / F.lit(2.0)), F.lit(2))


def haversine_a(start_lon: Column, end_lon: Column, start_lat: Column, end_lat: Column) -> Column:
    """a = hav(Δφ) + cos φ1 · cos φ2 · hav(Δλ), arguments in degrees."""
    phi1 = F.radians(start_lat)
    phi2 = F.radians(end_lat)
    lam1 = F.radians(start_lon)
    lam2 = F.radians(end_lon)
    return half_chord(phi2 - phi1) + F.cos(phi1) * F.cos(phi2) * half_chord(lam2 - lam1)


def central_angle(a: Column) -> Column:
    """c = 2 · atan2(√a, √(1 − a)); NaN when ``a`` lies outside [0, 1]."""
    return F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)) * F.lit(2.0)


def ieee_divide(num: Column, den: Column) -> Column:
    """Floating-point division with IEEE results for a zero divisor.

    ``x / 0`` is ±Infinity and ``0 / 0`` (or NaN / 0) is NaN, as in Java
    double arithmetic; Spark's ANSI ``/`` would raise instead.
    """
    num_d = num.cast("double")
    den_d = den.cast("double")
    at_zero = (
        F.when(num_d.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(num_d) | (num_d == F.lit(0.0)), F.lit(float("nan")))
        .when(num_d > F.lit(0.0), F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )
    return F.when(den_d == F.lit(0.0), at_zero).otherwise(F.try_divide(num_d, den_d))


def speed(distance: Column, duration: Column, zero_division: str = "null") -> Column:
    """distance / duration.

    ``zero_division="null"``: a zero duration gives NULL (``try_divide``) — no
    ANSI error, sorted last. ``"ieee"``: Java double semantics (Infinity/NaN).
    """
    if zero_division == "null":
        return F.try_divide(distance.cast("double"), duration.cast("double"))
    if zero_division == "ieee":
        return ieee_divide(distance, duration)
    raise ValueError(f"zero_division must be 'null' or 'ieee', got {zero_division!r}")

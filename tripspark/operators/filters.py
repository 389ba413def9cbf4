"""Row filters. All are plain predicates, so Catalyst pushes the single-column
ones (ranges, IS NOT NULL, NOT <=> 0, = literal) into the Parquet scan."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.schemas import TRIPS, TripRoles

# Valid coordinate domains (closed intervals, degrees).
LON_BOUNDS = (-180.0, 180.0)
LAT_BOUNDS = (-90.0, 90.0)


def point_lookup(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows whose ``column`` equals ``value`` (pushed down as ``EqualTo``)."""
    return df.where(F.col(column) == F.lit(value))


def coordinate_predicate(
    roles: TripRoles = TRIPS,
    *,
    require_nonzero: bool = True,
    require_moved: bool = True,
    lon_bounds: tuple[float, float] = LON_BOUNDS,
    lat_bounds: tuple[float, float] = LAT_BOUNDS,
) -> Column:
    """Conjunction of the coordinate-cleaning rules.

    * every longitude in ``lon_bounds`` and latitude in ``lat_bounds``
      (inclusive; drops NULL and NaN),
    * ``require_nonzero``: no coordinate equals 0 (null-safe comparison),
    * ``require_moved``: start and end differ on *both* axes, so trips that
      run due north/south or due east/west are dropped as well.
    """
    slon, slat, elon, elat = (F.col(c) for c in roles.coordinates)
    pred = (
        slon.between(*lon_bounds)
        & slat.between(*lat_bounds)
        & elon.between(*lon_bounds)
        & elat.between(*lat_bounds)
    )
    if require_nonzero:
        for c in (slon, slat, elon, elat):
            pred = pred & ~c.eqNullSafe(F.lit(0.0))
    if require_moved:
        pred = pred & (slon != elon) & (slat != elat)
    return pred


def valid_coordinates(df: DataFrame, roles: TripRoles = TRIPS, **rules: Any) -> DataFrame:
    """Keep trips whose coordinates pass :func:`coordinate_predicate`."""
    return df.where(coordinate_predicate(roles, **rules))


def positive_duration(df: DataFrame, roles: TripRoles = TRIPS) -> DataFrame:
    """Keep trips that end strictly after they start."""
    return df.where(F.col(roles.end) > F.col(roles.start))


def timestamp_literal(df: DataFrame, column: str, value: str) -> Column:
    """``value`` as a literal of ``df[column]``'s timestamp type (NTZ or not),
    so the comparison is pushed to the scan without a cast on the column."""
    return F.lit(value).cast(df.schema[column].dataType)


def after_cutoff(df: DataFrame, column: str, cutoff: str, *, inclusive: bool = True) -> DataFrame:
    """``column >= cutoff`` (inclusive) or ``column > cutoff``."""
    lit = timestamp_literal(df, column, cutoff)
    return df.where(F.col(column) >= lit if inclusive else F.col(column) > lit)

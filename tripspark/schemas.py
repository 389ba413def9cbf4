"""Fixed schemas of the trip and vendor tables and column-role mappings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column order and types of the two input tables (headerless CSV,
# positional). Coordinates are renamed startLon/startLat/endLon/endLat.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("startDate", T.TimestampType(), False),
        T.StructField("endDate", T.TimestampType(), False),
        T.StructField("startLon", T.DoubleType(), False),
        T.StructField("startLat", T.DoubleType(), False),
        T.StructField("endLon", T.DoubleType(), False),
        T.StructField("endLat", T.DoubleType(), False),
        T.StructField("cost", T.DoubleType(), False),
    ]
)

VENDOR_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("vendor", T.IntegerType(), False),
    ]
)


def with_timestamp_type(schema: T.StructType, ts_type: T.DataType) -> T.StructType:
    """Copy of ``schema`` whose timestamp fields use ``ts_type`` (e.g. NTZ)."""
    fields = []
    for f in schema.fields:
        dt = ts_type if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else f.dataType
        fields.append(T.StructField(f.name, dt, f.nullable))
    return T.StructType(fields)


TRIP_SCHEMA_NTZ = with_timestamp_type(TRIP_SCHEMA, T.TimestampNTZType())


@dataclass(frozen=True)
class TripRoles:
    """Which column plays which role in a fact table of trips."""

    id: str = "id"
    start: str = "startDate"
    end: str = "endDate"
    start_lon: str = "startLon"
    start_lat: str = "startLat"
    end_lon: str = "endLon"
    end_lat: str = "endLat"
    cost: str = "cost"

    @property
    def coordinates(self) -> tuple[str, str, str, str]:
        return (self.start_lon, self.start_lat, self.end_lon, self.end_lat)


@dataclass(frozen=True)
class VendorRoles:
    """Key and attribute columns of the trip → vendor bridge table."""

    id: str = "id"
    vendor: str = "vendor"


TRIPS = TripRoles()
VENDORS = VendorRoles()

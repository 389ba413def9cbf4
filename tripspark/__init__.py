"""tripspark — trip analytics expressed as plain PySpark DataFrame plans.

Every public function is ``DataFrame -> DataFrame`` or ``Column -> Column``;
nothing collects unbounded data to the driver and nothing mutates the
session configuration.

Quick start::

    from tripspark import read_trips_csv, read_vendors_csv, avg_trip_duration_per_hour
    trips = read_trips_csv(spark, "hdfs:///data/trips.csv")
    avg_trip_duration_per_hour(trips).show()
"""

from tripspark.plans.programs import run_dataframe_program, run_join_program, run_text_program
from tripspark.plans.trip_queries import (
    avg_trip_duration_per_hour,
    clean_trips,
    fastest_trips,
    lookup_trip,
    max_trip_cost_per_vendor,
    parsed_trips,
)
from tripspark.schemas import TRIP_SCHEMA, TRIP_SCHEMA_NTZ, VENDOR_SCHEMA, TripRoles, VendorRoles
from tripspark.sources import (
    parse_trip_lines,
    parse_vendor_lines,
    read_text_lines,
    read_trips_csv,
    read_vendors_csv,
)

__all__ = [
    "TRIP_SCHEMA",
    "TRIP_SCHEMA_NTZ",
    "VENDOR_SCHEMA",
    "TripRoles",
    "VendorRoles",
    "avg_trip_duration_per_hour",
    "clean_trips",
    "fastest_trips",
    "lookup_trip",
    "max_trip_cost_per_vendor",
    "parse_trip_lines",
    "parse_vendor_lines",
    "parsed_trips",
    "read_text_lines",
    "read_trips_csv",
    "read_vendors_csv",
    "run_dataframe_program",
    "run_join_program",
    "run_text_program",
]

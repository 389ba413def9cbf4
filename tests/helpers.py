"""Small hand-made frames for unit tests."""

import datetime as dt

from pyspark.sql import types as T

from tripspark.schemas import TRIP_SCHEMA_NTZ, VENDOR_SCHEMA

NULLABLE_TRIPS = T.StructType([T.StructField(f.name, f.dataType, True) for f in TRIP_SCHEMA_NTZ.fields])
NULLABLE_VENDORS = T.StructType([T.StructField(f.name, f.dataType, True) for f in VENDOR_SCHEMA.fields])


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def trip(i, start, end, slon=-73.9, slat=40.7, elon=-73.8, elat=40.8, cost=10.0):
    return (i, ts(start), ts(end), slon, slat, elon, elat, cost)


def trips_df(spark, rows):
    return spark.createDataFrame(rows, NULLABLE_TRIPS)


def vendors_df(spark, rows):
    return spark.createDataFrame(rows, NULLABLE_VENDORS)

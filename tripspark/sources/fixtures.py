"""Derived ``trips`` and ``vendors`` tables over the driver's ``events`` table.

The driver tables hold no trips, so the trip fact table is derived row-locally
from ``events`` (one scan, no shuffle): the key is ``event_id``, the start is
``ts``, and the end time and coordinates follow fixed arithmetic rules that
plant dirty rows on purpose (negative and sub-second durations, NULL / zero /
out-of-range coordinates, trips that do not move along one axis). Work grows
linearly with ``events``. :func:`materialize` stores both tables as Parquet
once per application, so queries scan them like any stored fact table.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.schemas import TRIP_SCHEMA_NTZ, VENDOR_SCHEMA
from tripspark.session import scratch_path
from tripspark.sources.parquet import read_table


def _mulmod(k: Column, factor: int, modulus: int) -> Column:
    """``(k * factor) % modulus`` for k >= 0 without 64-bit overflow."""
    return ((k % F.lit(modulus)) * F.lit(factor % modulus)) % F.lit(modulus)


def _grid(k: Column, factor: int, modulus: int, offset: float) -> Column:
    return _mulmod(k, factor, modulus).cast("double") / F.lit(100.0) - F.lit(offset)


# The derivation rules of the trips/vendors views.
def trips_from_events(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    offset_ms = F.when(k % 997 == 0, F.lit(400)).otherwise(_mulmod(k, 37003, 7200000) - F.lit(600000))
    end = F.timestamp_add("MILLISECOND", offset_ms, F.col("ts"))
    start_lon = (
        F.when(k % 113 == 0, F.lit(None).cast("double"))
        .when(k % 101 == 0, F.lit(0.0))
        .otherwise(_grid(k, 7919, 36000, 180.0))
    )
    start_lat = F.when(k % 103 == 0, F.lit(95.0)).otherwise(_grid(k, 104729, 18000, 90.0))
    end_lon = F.when(k % 107 == 0, _grid(k, 7919, 36000, 180.0)).otherwise(_grid(k, 15485863, 36000, 180.0))
    end_lat = F.when(k % 109 == 0, _grid(k, 104729, 18000, 90.0)).otherwise(_grid(k, 32452843, 18000, 90.0))
    return events.select(
        k.alias("id"),
        F.col("ts").alias("startDate"),
        end.alias("endDate"),
        start_lon.alias("startLon"),
        start_lat.alias("startLat"),
        end_lon.alias("endLon"),
        end_lat.alias("endLat"),
        F.col("value").alias("cost"),
    )


def vendors_from_events(events: DataFrame) -> DataFrame:
    """Every id not divisible by 20 gets vendor 1 or 2; ids divisible by 211 also
    get vendor 3 — so some trips have no vendor and some have two. One scan:
    the (at most two) vendor rows per event come from ``explode``."""
    k = F.col("event_id")
    first = F.when(k % 20 != 0, (F.lit(1) + k % 2).cast("int"))
    second = F.when(k % 211 == 0, F.lit(3).cast("int"))
    return events.select(
        k.alias("id"), F.explode(F.array_compact(F.array(first, second))).alias("vendor")
    )


# Schemas of the stored tables (every column nullable, as Parquet reads them).
DERIVED_TRIP_SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in TRIP_SCHEMA_NTZ.fields])
DERIVED_VENDOR_SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in VENDOR_SCHEMA.fields])

# (application id, events path, file signature) -> (trips path, vendors path)
_MATERIALIZED: dict[tuple, tuple[str, str]] = {}
_LOCK = threading.Lock()


def _signature(path: str):
    try:
        st = os.stat(path)
        return (st.st_mtime_ns, st.st_size)
    except OSError:
        return None


def materialize(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Write the derived trips and vendors tables once per application as
    Parquet below the shared checkpoint folder and return their paths.

    Queries then scan a stored fact table, as they would in production: the
    scan prunes columns and receives pushed filters, and the derivation is not
    inlined into every filter predicate by the optimizer.
    """
    events_path = f"{str(sf_dir).rstrip('/')}/events.parquet"
    key = (spark.conf.get("spark.app.id", None), os.path.abspath(events_path), _signature(events_path))
    with _LOCK:
        if key not in _MATERIALIZED:
            base = scratch_path(spark, "derived-trips")
            events = read_table(spark, sf_dir, "events")
            trips_from_events(events).write.mode("overwrite").parquet(f"{base}/trips")
            vendors_from_events(events.select("event_id")).write.mode("overwrite").parquet(f"{base}/vendors")
            _MATERIALIZED[key] = (f"{base}/trips", f"{base}/vendors")
        return _MATERIALIZED[key]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived trips table (materialized once per application). Read with
    its fixed schema, so no footer-reading job runs to infer it."""
    return spark.read.schema(DERIVED_TRIP_SCHEMA).parquet(materialize(spark, sf_dir)[0])


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived trip → vendor table (materialized once per application)."""
    return spark.read.schema(DERIVED_VENDOR_SCHEMA).parquet(materialize(spark, sf_dir)[1])

"""Typed, headerless CSV reads with an explicit schema (nothing inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripspark.schemas import TRIP_SCHEMA, VENDOR_SCHEMA

# Fixed value: the timestamp pattern of the trip CSV. It has no fraction, so a
# value such as "2015-03-10 06:00:00.5" parses to NULL under PERMISSIVE mode;
# pass a pattern like "yyyy-MM-dd HH:mm:ss[.SSSSSS]" to accept fractions.
REFERENCE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    sep: str = ",",
    timestamp_format: str | None = None,
    mode: str = "PERMISSIVE",
    header: bool = False,
) -> DataFrame:
    """``spark.read.csv`` with a fixed schema.

    PERMISSIVE (default): a bad field becomes NULL, a short row is padded
    with NULLs, extra fields are dropped and blank lines are skipped.
    FAILFAST raises on the first malformed row.
    """
    if mode.upper() not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}, got {mode!r}")
    reader = spark.read.format("csv").schema(schema).option("sep", sep).option("mode", mode.upper())
    reader = reader.option("header", str(bool(header)).lower())
    if timestamp_format is not None:
        reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    return reader.load(path)


def read_trips_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType = TRIP_SCHEMA,
    timestamp_format: str = REFERENCE_TIMESTAMP_FORMAT,
    mode: str = "PERMISSIVE",
    sep: str = ",",
) -> DataFrame:
    """Trip CSV: ``id,startDate,endDate,startLon,startLat,endLon,endLat,cost``."""
    return read_csv_table(spark, path, schema, sep=sep, timestamp_format=timestamp_format, mode=mode)


def read_vendors_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType = VENDOR_SCHEMA,
    mode: str = "PERMISSIVE",
    sep: str = ",",
) -> DataFrame:
    """Vendor CSV: ``id,vendor``."""
    return read_csv_table(spark, path, schema, sep=sep, mode=mode)

"""Readers: typed CSV, Parquet, raw text lines, and the derived trip tables."""

from tripspark.sources.csv import REFERENCE_TIMESTAMP_FORMAT, read_csv_table, read_trips_csv, read_vendors_csv
from tripspark.sources.fixtures import trips, vendors
from tripspark.sources.parquet import read_parquet_table, read_table
from tripspark.sources.text import (
    SplitRecords,
    classified_lines,
    extract_start_hour,
    extract_trip_id,
    extract_vendor_id,
    line_field,
    parse_trip_lines,
    parse_vendor_lines,
    read_text_lines,
    split_records,
)

__all__ = [
    "REFERENCE_TIMESTAMP_FORMAT",
    "SplitRecords",
    "classified_lines",
    "extract_start_hour",
    "extract_trip_id",
    "extract_vendor_id",
    "line_field",
    "parse_trip_lines",
    "parse_vendor_lines",
    "read_csv_table",
    "read_parquet_table",
    "read_table",
    "read_text_lines",
    "read_trips_csv",
    "read_vendors_csv",
    "split_records",
    "trips",
    "vendors",
]

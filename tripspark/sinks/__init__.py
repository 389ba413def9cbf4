"""Writers: results in a chosen format, ``(key,value)`` text lines, CSV → Parquet."""

from tripspark.sinks.layout import compact, convert_csv, file_sizes, folder_size, write_lookup_table
from tripspark.sinks.writers import (
    ROUND_TRIP_TIMESTAMP_FORMAT,
    csv_to_parquet,
    pair_lines,
    replace_result,
    write_csv_table,
    write_pair_lines,
    write_result,
)

__all__ = [
    "ROUND_TRIP_TIMESTAMP_FORMAT",
    "compact",
    "convert_csv",
    "csv_to_parquet",
    "file_sizes",
    "folder_size",
    "pair_lines",
    "replace_result",
    "write_csv_table",
    "write_lookup_table",
    "write_pair_lines",
    "write_result",
]

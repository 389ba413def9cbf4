"""File layout of Parquet tables: even file sizes, range clustering and bloom filters.

* :func:`convert_csv` turns any CSV input — one huge file, thousands of tiny
  ones, compressed or not — into Parquet files near a target size. The number of
  files follows from the input's bytes and a bounded sample's Parquet bytes
  per text byte; if the written files miss the target (compressed input,
  say) they are rewritten once, from Parquet, with the count that their bytes ask for.
* :func:`write_lookup_table` lays a table out for lookups by a key. ``"range"`` clusters
  rows by key (one shuffle), so that minima and maxima in the footers exclude nearly
  every row group; ``"bloom"`` keeps the rows where they are and writes a
  bloom filter of the key per row group. Readers need nothing: an equality filter
  that reaches the scan uses either.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.session import scratch_path
from tripspark.sinks.writers import replace_result
from tripspark.sources.csv import read_csv_table

DEFAULT_FILE_BYTES = 256 * 1024 * 1024
#: Rows from which Parquet bytes per text byte are estimated.
SAMPLE_ROWS = 20_000
LAYOUTS = ("range", "bloom")


@dataclass(frozen=True)
class FolderSize:
    files: int
    bytes: int
    smallest: int
    largest: int


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of the data files below a folder (or of one file); contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def folder_size(spark: SparkSession, path: str) -> FolderSize:
    n, total, low, high = file_sizes(spark, path).agg(
        F.count(F.lit(1)), F.sum("length"), F.min("length"), F.max("length")).first()
    return FolderSize(n, total or 0, low or 0, high or 0)


def files_for(total_bytes: float, target_file_bytes: int) -> int:
    return max(1, round(total_bytes / target_file_bytes))


def even_partitions(df: DataFrame, files: int, cluster_by: str | None = None) -> DataFrame:
    """``df`` in ``files`` partitions of even size, clustered and sorted by ``cluster_by`` if given. Rows
    of a hot key are told apart by a hash of the row, so that they may span files."""
    if cluster_by is None:
        return df.repartition(files)
    salt = F.xxhash64(*[f"`{c}`" for c in df.columns])
    return df.repartitionByRange(files, F.col(cluster_by), salt).sortWithinPartitions(F.col(cluster_by))


def write_lookup_table(df: DataFrame, path: str, key: str, *, layout: str = "range", files: int | None = None,
                       keys_per_row_group: int | None = None, row_group_bytes: int | None = None) -> str:
    """Write ``df`` as Parquet for lookups by ``key`` (see the module's text). ``files``: how many files to write
    (``"bloom"`` may leave it out and then writes one file per task, without a shuffle).
    ``keys_per_row_group`` sizes the bloom filters (else Parquet's default of 1 MB each)."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    options = {"parquet.block.size": str(row_group_bytes)} if row_group_bytes else {}
    if layout == "range":
        if files is None:
            raise ValueError("range clustering needs a number of files")
        df = even_partitions(df, files, key)
    else:
        df = df if files is None else even_partitions(df, files)
        options[f"parquet.bloom.filter.enabled#{key}"] = "true"
        if keys_per_row_group:
            options[f"parquet.bloom.filter.expected.ndv#{key}"] = str(keys_per_row_group)
    return replace_result(df, path, "parquet", options=options)


def parquet_bytes_expected(spark: SparkSession, csv_path: str, schema: T.StructType, *, sample_rows: int = SAMPLE_ROWS,
                           timestamp_format: str | None = None, mode: str = "PERMISSIVE") -> float:
    """Parquet bytes that the CSV input will take: its bytes, times a bounded sample's Parquet bytes per text byte."""
    total = folder_size(spark, csv_path).bytes
    lines, text = spark.read.text(csv_path).limit(sample_rows).agg(
        F.count(F.lit(1)), F.sum(F.octet_length("value") + 1)).first()
    if not lines:
        return 0.0
    sample = scratch_path(spark, "layout-sample")
    rows = read_csv_table(spark, csv_path, schema, timestamp_format=timestamp_format, mode=mode)
    rows.limit(lines).coalesce(1).write.parquet(sample)  # at most sample_rows rows
    return total * folder_size(spark, sample).bytes / text


def convert_csv(spark: SparkSession, csv_path: str, parquet_path: str, schema: T.StructType, *,
                target_file_bytes: int = DEFAULT_FILE_BYTES, cluster_by: str | None = None,
                timestamp_format: str | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV → Parquet files near ``target_file_bytes`` (replacing ``parquet_path`` at the end), and the table they form.
    ``cluster_by`` also range-clusters it for lookups by that column."""
    expected = parquet_bytes_expected(spark, csv_path, schema, timestamp_format=timestamp_format, mode=mode)
    files = files_for(expected, target_file_bytes)
    rows = read_csv_table(spark, csv_path, schema, timestamp_format=timestamp_format, mode=mode)
    replace_result(even_partitions(rows, files, cluster_by), parquet_path, "parquet")
    compact(spark, parquet_path, rows.schema, target_file_bytes=target_file_bytes, cluster_by=cluster_by)
    # the schema is known: reading with it skips the footer-inference job
    return spark.read.schema(rows.schema).parquet(parquet_path)


def compact(spark: SparkSession, path: str, schema: T.StructType | None = None, *,
            target_file_bytes: int = DEFAULT_FILE_BYTES, cluster_by: str | None = None) -> bool:
    """Rewrite a Parquet folder if its files' mean or largest size is off the target by over a half; True if it was."""
    size = folder_size(spark, path)
    files = files_for(size.bytes, target_file_bytes)
    if not size.files or (files <= ceil(1.5 * size.files) and size.files <= ceil(1.5 * files)
                          and (files == 1 or size.largest <= 1.5 * target_file_bytes)):
        return False
    reader = spark.read if schema is None else spark.read.schema(schema)
    replace_result(even_partitions(reader.parquet(path), files, cluster_by), path, "parquet")
    return True

"""Sinks. Writes are distributed (one file per task) unless ``single_file`` is
requested, which is only meant for small, bounded results such as a
per-hour or per-vendor aggregate or a top-k."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.sources.csv import read_csv_table

# Timestamp pattern for CSV copies we write ourselves: keeps microseconds, so a
# CSV round trip is lossless (a pattern without a fraction would turn such
# values into NULL on read).
ROUND_TRIP_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_result(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    mode: str = "overwrite",
    single_file: bool = False,
    options: dict[str, str] | None = None,
) -> str:
    """``df.write.format(fmt).mode(mode).save(path)``; CSV is written without a
    header. ``single_file`` coalesces to one partition after any sort (order is
    kept) — use it only for bounded results."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.format(fmt).mode(mode)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path)
    return path


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and ``path`` for it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def replace_result(df: DataFrame, path: str, fmt: str = "parquet", *, single_file: bool = False,
                   options: dict[str, str] | None = None) -> str:
    """Overwrite ``path`` only once the new result is complete: it is written to a fresh folder beside
    ``path`` and takes its place by renaming. A write that fails leaves the former
    result as it was. The input may read ``path`` itself. (Renaming is one step on HDFS and local
    file systems; stores without it copy, so use a table format there.)"""
    spark, place = df.sparkSession, path.rstrip("/")
    mark = uuid.uuid4().hex
    fresh, former = f"{place}.new-{mark}", f"{place}.old-{mark}"
    fs, target = _file_system(spark, place)
    try:
        write_result(df, fresh, fmt, mode="error", single_file=single_file, options=options)
    except BaseException:
        fs.delete(_file_system(spark, fresh)[1], True)
        raise
    had = fs.exists(target)
    if had and not fs.rename(target, _file_system(spark, former)[1]):
        raise OSError(f"cannot move the former result at {place}")
    if not fs.rename(_file_system(spark, fresh)[1], target):
        if had:
            fs.rename(_file_system(spark, former)[1], target)
        raise OSError(f"cannot move the new result to {place}")
    if had:
        fs.delete(_file_system(spark, former)[1], True)
    return path


def write_csv_table(df: DataFrame, path: str, *, timestamp_format: str = ROUND_TRIP_TIMESTAMP_FORMAT,
                    mode: str = "overwrite", sep: str = ",") -> str:
    """Headerless CSV with an explicit timestamp pattern (both timestamp kinds)."""
    return write_result(
        df,
        path,
        "csv",
        mode=mode,
        options={
            "sep": sep,
            "header": "false",
            "timestampFormat": timestamp_format,
            "timestampNTZFormat": timestamp_format,
        },
    )


def pair_lines(df: DataFrame, key: str | Column, value: str | Column, *, value_format: str | None = None) -> DataFrame:
    """Render ``(key,value)`` text lines (column ``value``), the textual form of a
    key/value pair. ``value_format`` (e.g. ``"%.6f"``) fixes the number format;
    by default the value is cast to string."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    v_text = F.format_string(value_format, v) if value_format else v.cast("string")
    line = F.concat(F.lit("("), F.coalesce(k.cast("string"), F.lit("null")), F.lit(","),
                    F.coalesce(v_text, F.lit("null")), F.lit(")"))
    return df.select(line.alias("value"))


def write_pair_lines(
    df: DataFrame,
    key: str | Column,
    value: str | Column,
    path: str,
    *,
    single_file: bool = False,
    value_format: str | None = None,
    keep_former: bool = False,
) -> str:
    """Write ``(key,value)`` lines as text, overwriting ``path`` (stale part files
    are removed, unlike a plain directory reuse). ``keep_former``: a write that fails
    leaves the former result (:func:`replace_result`)."""
    lines = pair_lines(df, key, value, value_format=value_format)
    write = replace_result if keep_former else write_result
    return write(lines, path, "text", single_file=single_file)


def csv_to_parquet(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: T.StructType,
    *,
    timestamp_format: str | None = None,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Read a typed CSV table, write it as Parquet (overwrite) and return the
    Parquet copy, whose later scans are columnar with pushdown."""
    df = read_csv_table(spark, csv_path, schema, timestamp_format=timestamp_format, mode=mode)
    df.write.mode("overwrite").parquet(parquet_path)
    # the schema is known: reading with it skips the footer-inference job
    return spark.read.schema(df.schema).parquet(parquet_path)

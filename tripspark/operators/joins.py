"""Equi-joins with an explicit, per-query strategy.

Strategies are chosen with join hints on the DataFrame, never by changing
session settings (``autoBroadcastJoinThreshold`` etc.), so one query cannot
change how another one is planned.

* ``"auto"``         — planner's choice; adaptive execution may still switch to
                       a broadcast at runtime from measured sizes.
* ``"broadcast"``    — broadcast hash join, only when the build side has a proven
                       size bound (``dim_max_rows`` × fixed row width ≤ byte
                       budget); otherwise falls back to ``"auto"``.
* ``"merge"``        — sort-merge join (both sides shuffled on the key).
* ``"shuffle_hash"`` — shuffled hash join.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")

# Byte widths used to bound the size of a build side from its schema.
_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}
_VARIABLE_WIDTH_ESTIMATE = 64
_DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def row_width(schema: T.StructType) -> int:
    """Upper-bound-ish bytes per row (fixed-width types exact, plus a row header)."""
    width = 8
    for f in schema.fields:
        width += _FIXED_WIDTH.get(type(f.dataType), _VARIABLE_WIDTH_ESTIMATE)
    return width


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def byte_size(text: str) -> int:
    """Bytes of a Spark size string: ``10485760``, ``10485760b``, ``50MB``, ``1g``; ``-1`` stays negative."""
    match = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)(?:i?b)?\s*", text.lower())
    if not match:
        raise ValueError(f"not a size: {text!r}")
    return int(match[1]) * _UNITS[match[2]]


def broadcast_budget(df: DataFrame, max_bytes: int | None = None) -> int:
    """Byte budget for a broadcast side: explicit, else the session's
    ``spark.sql.autoBroadcastJoinThreshold`` (read, never written). 0: broadcasting is off."""
    if max_bytes is not None:
        return int(max_bytes)
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    return max(0, byte_size(str(raw))) if raw is not None else _DEFAULT_BROADCAST_BYTES


def is_fixed_width(schema: T.StructType) -> bool:
    """True when every column has a fixed byte width (numbers, dates, timestamps)."""
    return all(type(f.dataType) in _FIXED_WIDTH for f in schema.fields)


def fits_broadcast(df: DataFrame, max_rows: int | None, max_bytes: int | None = None) -> bool:
    """True when the schema proves that the side fits the broadcast budget: ``max_rows`` is a known
    row bound and every column has a fixed width. With variable widths nothing is proven: then
    no hint is given, and Spark's own size check (estimate, then measured size) decides."""
    if max_rows is None or not is_fixed_width(df.schema):
        return False
    return int(max_rows) * row_width(df.schema) <= broadcast_budget(df, max_bytes)


def bounded_broadcast(df: DataFrame, max_rows: int | None, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its size bound fits, else ``df`` unchanged. Asked for by name, it also
    holds where the session switches implicit broadcasts off."""
    explicit = max_bytes if max_bytes is not None else (broadcast_budget(df) or _DEFAULT_BROADCAST_BYTES)
    return F.broadcast(df) if fits_broadcast(df, max_rows, explicit) else df


def limited_dimension(dim: DataFrame, key, n: int) -> DataFrame:
    """The first ``n`` rows of ``dim`` by ``key`` (a column name or a list of
    them, for a total order when keys repeat) — a deterministic ``limit(n)``.

    Plans as a per-partition top-n followed by one small merge, so it never
    sorts the whole dimension and its result has a proven bound of ``n`` rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return dim.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(int(n))


def any_rows(dim: DataFrame, n: int) -> DataFrame:
    """Some ``n`` rows of ``dim`` (which ones is open), reading only as many files as that takes: tasks
    start on one partition and go on to more while rows are missing. The ``n`` rows pass through the
    driver, so ``n`` must be small; :func:`limited_dimension` is the deterministic form."""
    return dim.sparkSession.createDataFrame(dim.limit(int(n)).collect(), dim.schema)


def reduced_by_keys(rows: DataFrame, others: DataFrame, key: str, other_key: str, *, max_bytes: int | None = None) -> DataFrame:
    """``rows`` without most of those whose ``key`` no row of ``others`` has, before a join shuffles them.

    The keys of ``others`` are hashed into as many buckets as the broadcast budget has room for (16 bytes
    each), so the broadcast has a proven bound whatever the number of keys; rows in no occupied bucket go. Rows
    that share a bucket with a key stay, so a join must follow. Worth its extra pass over
    ``others`` where those are the few that a filter left. With broadcasting off, ``rows`` stay as they are."""
    buckets = broadcast_budget(rows, max_bytes) // 16
    if buckets < 1024:
        return rows
    bucket = lambda c: F.pmod(F.xxhash64(c.cast("string")), F.lit(buckets))
    occupied = others.where(F.col(other_key).isNotNull()).select(bucket(F.col(other_key)).alias("_bucket")).distinct()
    return rows.join(F.broadcast(occupied), bucket(F.col(key)) == F.col("_bucket"), "left_semi")


def join_with_strategy(
    facts: DataFrame,
    dims: DataFrame,
    on,
    *,
    strategy: str = "auto",
    how: str = "inner",
    dim_max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """``facts ⋈ dims`` with the requested physical strategy (see module doc).

    ``on`` is a column name / list of names (the key appears once in the
    output) or a join condition Column.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if strategy == "broadcast":
        dims = bounded_broadcast(dims, dim_max_rows, max_bytes)
    elif strategy == "merge":
        dims = dims.hint("merge")
    elif strategy == "shuffle_hash":
        dims = dims.hint("shuffle_hash")
    return facts.join(dims, on, how)

"""The three end-to-end programs, as functions of paths (no command line).

* :func:`run_dataframe_program` — typed CSV in (optionally converted to
  Parquet first), point lookup, Q1/Q2/Q3 written in the input's format.
* :func:`run_text_program` — raw text lines in, Q1/Q2/Q3 written as
  ``(key,value)`` text lines, one file per result.
* :func:`run_join_program` — Parquet trips ⋈ the first ``n`` vendors under the
  planner's default strategy and with broadcasting ruled out, by a hint and by settings,
  reported from the plans that ran.

Each returns the output paths and the seconds spent in each action. Timings
measure the actions (writes), never plan construction alone.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripspark.operators import joins
from tripspark.plans import explain, line_queries, trip_queries
from tripspark.schemas import TRIP_SCHEMA, VENDOR_SCHEMA
from tripspark.session import NO_BROADCAST, session_with
from tripspark.sinks import convert_csv, replace_result, write_pair_lines
from tripspark.sinks.layout import DEFAULT_FILE_BYTES
from tripspark.sources import (
    REFERENCE_TIMESTAMP_FORMAT,
    parse_trip_lines,
    parse_vendor_lines,
    read_text_lines,
    read_trips_csv,
    read_vendors_csv,
)

# Result names (folder names below the results path; the typed
# program adds "." + format).
RESULT_NAMES = ("Q1", "Q2", "Q3")
RESULT_FILES = {"Q1": "Q1_results", "Q2": "Q2_results", "Q3": "Q3_results"}

# The text program reads vendor ids as 64-bit numbers.
_VENDOR_LONG_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("vendor", T.LongType())])


@dataclass
class ProgramRun:
    outputs: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    frames: dict[str, DataFrame] = field(default_factory=dict)


def _timed(run: ProgramRun, name: str, action) -> None:
    t0 = time.perf_counter()
    action()
    run.seconds[name] = time.perf_counter() - t0


def run_dataframe_program(
    spark: SparkSession,
    trips_csv: str,
    vendors_csv: str,
    results_dir: str,
    *,
    parquet_trips: str | None = None,
    parquet_vendors: str | None = None,
    cutoff: str = trip_queries.DEFAULT_CUTOFF,
    lookup_id: int = trip_queries.LOOKUP_TRIP_ID,
    timestamp_format: str = REFERENCE_TIMESTAMP_FORMAT,
    k: int = trip_queries.DEFAULT_K,
    target_file_bytes: int = DEFAULT_FILE_BYTES,
) -> ProgramRun:
    """CSV → (optional Parquet copy) → lookup, Q1, Q2, Q3 → ``results_dir/Qn_results.<fmt>``.

    Passing both ``parquet_*`` paths converts the inputs first and runs the
    questions on the Parquet copies; results are then written as Parquet,
    otherwise as header-less CSV. The copies have files near ``target_file_bytes`` and
    are clustered by trip id, so the lookup skips nearly all row groups. A result
    replaces the former one only when it is complete.
    """
    run = ProgramRun()
    trips = read_trips_csv(spark, trips_csv, schema=TRIP_SCHEMA, timestamp_format=timestamp_format)
    vendors = read_vendors_csv(spark, vendors_csv, schema=VENDOR_SCHEMA)
    fmt = "csv"
    if parquet_trips and parquet_vendors:
        fmt = "parquet"
        t0 = time.perf_counter()
        trips = convert_csv(spark, trips_csv, parquet_trips, TRIP_SCHEMA, target_file_bytes=target_file_bytes,
                            cluster_by="id", timestamp_format=timestamp_format)
        vendors = convert_csv(spark, vendors_csv, parquet_vendors, VENDOR_SCHEMA, target_file_bytes=target_file_bytes,
                              cluster_by="id")
        run.seconds["convert"] = time.perf_counter() - t0
    run.frames["lookup"] = trip_queries.lookup_trip(trips, lookup_id)
    results = {
        "Q1": trip_queries.avg_trip_duration_per_hour(trips),
        "Q2": trip_queries.max_trip_cost_per_vendor(trips, vendors),
    }
    t0 = time.perf_counter()
    results["Q3"] = trip_queries.fastest_trips(trips, vendors, k=k, cutoff=cutoff)
    run.seconds["Q3_candidates"] = time.perf_counter() - t0
    for name in RESULT_NAMES:
        path = f"{results_dir.rstrip('/')}/{RESULT_FILES[name]}.{fmt}"
        run.frames[name] = results[name]
        _timed(run, name, lambda df=results[name], p=path: replace_result(df, p, fmt))
        run.outputs[name] = path
    return run


def run_text_program(
    spark: SparkSession,
    trips_text: str,
    vendors_text: str,
    results_dir: str,
    *,
    cutoff: str = trip_queries.DEFAULT_CUTOFF,
    k: int = trip_queries.DEFAULT_K,
) -> ProgramRun:
    """Raw lines → Q1/Q2 from line fields, Q3 from strictly parsed records →
    ``(key,value)`` text files (Q1 and Q3 in one file each: bounded)."""
    run = ProgramRun()
    trip_lines = read_text_lines(spark, trips_text)
    vendor_lines = read_text_lines(spark, vendors_text)
    q1 = line_queries.avg_duration_by_hour_from_lines(trip_lines)
    q2 = line_queries.max_cost_by_vendor_from_lines(trip_lines, vendor_lines)
    typed_trips = parse_trip_lines(trip_lines, strict=True)
    # record parsing fails on a malformed token whatever the session's ANSI mode
    typed_vendors = parse_vendor_lines(vendor_lines, schema=_VENDOR_LONG_SCHEMA, strict=True)
    q3 = trip_queries.fastest_trips(typed_trips, typed_vendors, variant="rdd", k=k, cutoff=cutoff)
    # (frame, key, value, single file): one file only where the row count has a
    # proven bound (≤ 25 hours, k trips); vendors are written one file per task.
    pairs = {
        "Q1": (q1, "HourOfDay", "AverageTripDuration", True),
        "Q2": (q2, "VendorId", "MaxTripCost", False),
        "Q3": (q3, "SpeedInMetersPerSec", "VendorCompanyId", True),
    }
    for name, (df, key, value, single) in pairs.items():
        path = f"{results_dir.rstrip('/')}/{RESULT_FILES[name]}"
        run.frames[name] = df
        _timed(run, name, lambda df=df, p=path, kk=key, vv=value, one=single: write_pair_lines(
            df, kk, vv, p, single_file=one, keep_former=True))
        run.outputs[name] = path
    return run


def run_join_program(
    spark: SparkSession,
    trips_parquet: str,
    vendors_parquet: str,
    *,
    n: int = 100,
    preview_rows: int = 20,
    ordered: bool = True,
    by_settings: bool = False,
) -> ProgramRun:
    """trips ⋈ first-``n`` vendors by id, once with the planner's default (a bounded side:
    broadcast) and once with a sort-merge hint; ``by_settings`` adds the default's definition planned in
    a session of its own that rules broadcasts out. ``outputs`` names the join operator that ran,
    ``seconds`` its time, ``frames["report"]`` has both with the rows of each run. ``ordered=False``
    takes any ``n`` vendors, reading only as much as that needs, once for all runs."""
    run = ProgramRun()

    def limited(session: SparkSession) -> DataFrame:
        return joins.limited_dimension(session.read.parquet(vendors_parquet), ["id", "vendor"], n)

    if not ordered:
        some = joins.any_rows(spark.read.parquet(vendors_parquet), n).collect()  # n rows

        def limited(session: SparkSession) -> DataFrame:
            return session.createDataFrame(some, VENDOR_SCHEMA)

    def joined(session: SparkSession, strategy: str) -> DataFrame:
        trips = session.read.parquet(trips_parquet)
        return joins.join_with_strategy(trips, limited(session), "id", strategy=strategy, dim_max_rows=n)

    frames = {strategy: joined(spark, strategy) for strategy in ("broadcast", "merge")}
    if by_settings:
        frames["no_broadcast"] = joined(session_with(spark, NO_BROADCAST), "auto")
    runs = []
    for strategy, df in frames.items():
        ran = explain.run_join(df, strategy, order=["id", "vendor"], preview_rows=preview_rows, measure="id")
        runs.append(ran)
        run.frames[strategy] = df
        run.frames[f"{strategy}_preview"] = df.sparkSession.createDataFrame(ran.preview, df.schema)
        run.outputs[strategy] = ran.executed
        run.seconds[strategy] = ran.seconds
    run.frames["report"] = explain.join_runs_report(spark, runs)
    return run

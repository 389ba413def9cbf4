"""Named queries: ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or the trips/vendors tables Spark
derives from ``events``) in full, so its work grows with the data. Queries
that exercise sinks write to a fresh folder below the shared checkpoint
folder and return the DataFrame that re-reads what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.functions.time import hour_label
from tripspark.operators import aggregates, filters, joins, metrics
from tripspark.plans import explain, line_queries, trip_queries
from tripspark.schemas import TRIP_SCHEMA, TRIP_SCHEMA_NTZ, VENDOR_SCHEMA
from tripspark.session import NO_BROADCAST, scratch_path, session_with
from tripspark.sinks import (
    ROUND_TRIP_TIMESTAMP_FORMAT,
    convert_csv,
    csv_to_parquet,
    folder_size,
    write_csv_table,
    write_lookup_table,
    write_pair_lines,
    write_result,
)
from tripspark.sources import (
    extract_start_hour,
    read_csv_table,
    read_table,
    read_text_lines,
    read_trips_csv,
    read_vendors_csv,
    split_records,
    trips,
    vendors,
)
from tripspark.sinks.layout import files_for
from tripspark.sources.fixtures import materialize
from tripspark.sources.text import parse_lines

# Fixed values of the registered queries.
TRIP_CUTOFF = "2024-01-10 00:00:00"   # Q3 date cut for the derived trips (events span January 2024)
LOOKUP_ORDER_KEY = 4242                # point lookup on orders
LIMITED_SUPPLIERS = 10                 # size of the truncated dimension
LOOKUP_TRIP_ID = 4242                  # point lookup on the trips table
LATE_CUTOFF = "2024-01-29 00:00:00"     # a selective date cut
LOOKUP_FILE_BYTES = 128 * 1024         # target file size of the tables laid out for lookups (test scale)
LOOKUP_KEYS_PER_FILE = 20_000          # sizes their bloom filters
LIMITED_VENDORS = 100                  # the join program's truncated vendor table
PREVIEW_ROWS = 20                      # rows of a console-style preview
ROUND_DIGITS = 6                       # trig results are compared after rounding

TRIP_COLUMNS = [f.name for f in TRIP_SCHEMA.fields]
LINEITEM_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str):
    return F.round(F.col(c), ROUND_DIGITS)


def _as_ntz(df: DataFrame) -> DataFrame:
    """Cast session-zone timestamps to NTZ (wall clock kept) for comparison."""
    return df.select(
        *[
            F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- the three trip programs -------------------------------------------------

def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    return filters.point_lookup(read_table(spark, d, "orders"), "o_orderkey", LOOKUP_ORDER_KEY)


def trip_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    return trip_queries.lookup_trip(trips(spark, d), LOOKUP_TRIP_ID)


def avg_duration_by_hour(spark: SparkSession, d: str) -> DataFrame:
    return trip_queries.avg_trip_duration_per_hour(trips(spark, d))


def max_cost_by_vendor(spark: SparkSession, d: str) -> DataFrame:
    return trip_queries.max_trip_cost_per_vendor(trips(spark, d), vendors(spark, d))


def valid_coordinates(spark: SparkSession, d: str) -> DataFrame:
    return filters.valid_coordinates(trips(spark, d))


def haversine_distance(spark: SparkSession, d: str) -> DataFrame:
    df = metrics.trip_metrics(filters.valid_coordinates(trips(spark, d)), guard_domain=False)
    return df.select(
        "id", _r(metrics.HAVERSINE_A).alias("haversine_a"), _r(metrics.DISTANCE).alias("distance")
    )


def trip_metrics(spark: SparkSession, d: str) -> DataFrame:
    cleaned = filters.positive_duration(filters.valid_coordinates(trips(spark, d)))
    df = metrics.trip_metrics(cleaned)
    return df.select(
        "id",
        metrics.DURATION,
        _r(metrics.HAVERSINE_A).alias(metrics.HAVERSINE_A),
        _r(metrics.CENTRAL_ANGLE).alias(metrics.CENTRAL_ANGLE),
        _r(metrics.DISTANCE).alias(metrics.DISTANCE),
        _r(metrics.SPEED).alias(metrics.SPEED),
    )


def top_k_fastest(spark: SparkSession, d: str) -> DataFrame:
    top = trip_queries.fastest_trips(trips(spark, d), vendors(spark, d), cutoff=TRIP_CUTOFF)
    return top.select(
        "VendorCompanyId",
        "TripId",
        _r("SpeedInMetersPerSec").alias("SpeedInMetersPerSec"),
        _r("DistanceInMeters").alias("DistanceInMeters"),
        "DurationInSec",
    )


def rdd_avg_duration_by_hour(spark: SparkSession, d: str) -> DataFrame:
    return trip_queries.avg_trip_duration_per_hour(trips(spark, d), variant="rdd")


def rdd_max_cost_by_vendor(spark: SparkSession, d: str) -> DataFrame:
    return trip_queries.max_trip_cost_per_vendor(trips(spark, d), vendors(spark, d), variant="rdd")


def rdd_top_k_fastest(spark: SparkSession, d: str) -> DataFrame:
    top = trip_queries.fastest_trips(trips(spark, d), vendors(spark, d), cutoff=TRIP_CUTOFF, variant="rdd")
    return top.select(_r("SpeedInMetersPerSec").alias("SpeedInMetersPerSec"), "VendorCompanyId")


# --- join strategies over a truncated dimension ----------------------------------

def _lineitem_and_suppliers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lineitem = read_table(spark, d, "lineitem")
    suppliers = joins.limited_dimension(read_table(spark, d, "supplier"), "s_suppkey", LIMITED_SUPPLIERS)
    return lineitem, suppliers


def _supplier_join(spark: SparkSession, d: str, strategy: str) -> DataFrame:
    lineitem, suppliers = _lineitem_and_suppliers(spark, d)
    return joins.join_with_strategy(
        lineitem,
        suppliers,
        lineitem["l_suppkey"] == suppliers["s_suppkey"],
        strategy=strategy,
        dim_max_rows=LIMITED_SUPPLIERS,
    )


def trip_vendor_limited_join(spark: SparkSession, d: str) -> DataFrame:
    """All trips ⋈ the first 100 vendor rows (by id, vendor), joined on ``id``
    so the key appears once; the truncated side has a proven bound."""
    limited = joins.limited_dimension(vendors(spark, d), ["id", "vendor"], LIMITED_VENDORS)
    return joins.join_with_strategy(trips(spark, d), limited, "id", strategy="broadcast",
                                    dim_max_rows=LIMITED_VENDORS)


def join_limited_dimension(spark: SparkSession, d: str) -> DataFrame:
    return _supplier_join(spark, d, "auto")


def join_strategy_broadcast(spark: SparkSession, d: str) -> DataFrame:
    return _supplier_join(spark, d, "broadcast")


def join_strategy_sort_merge(spark: SparkSession, d: str) -> DataFrame:
    return _supplier_join(spark, d, "merge")


def join_strategy_report(spark: SparkSession, d: str) -> DataFrame:
    lineitem, suppliers = _lineitem_and_suppliers(spark, d)
    return explain.join_strategy_report(
        lineitem,
        suppliers,
        lineitem["l_suppkey"] == suppliers["s_suppkey"],
        strategies=("broadcast", "merge"),
        dim_max_rows=LIMITED_SUPPLIERS,
        measure="l_orderkey",
    )


def join_preview(spark: SparkSession, d: str) -> DataFrame:
    joined = _supplier_join(spark, d, "auto")
    return joined.orderBy(*[F.col(c).asc_nulls_last() for c in LINEITEM_ORDER]).limit(PREVIEW_ROWS)


def join_run_report(spark: SparkSession, d: str) -> DataFrame:
    """The operator that ran (from the plan after the action), with the joined rows and a sum that were
    observed on the way. (The seconds of each run are left out: they differ from run to run.)"""
    frames = {"auto": _supplier_join(spark, d, "auto"), "merge": _supplier_join(spark, d, "merge"),
              "no_broadcast": join_without_broadcast(spark, d)}
    order = [F.col(c).asc_nulls_last() for c in LINEITEM_ORDER]
    runs = [explain.run_join(df, k, order=order, measure="l_orderkey") for k, df in frames.items()]
    return explain.join_runs_report(spark, runs, seconds=False)


def join_without_broadcast(spark: SparkSession, d: str) -> DataFrame:
    """The planner's-choice join, planned in a session of its own that rules broadcasts out."""
    return _supplier_join(session_with(spark, NO_BROADCAST), d, "auto")


def late_max_cost_by_vendor(spark: SparkSession, d: str) -> DataFrame:
    """Q2 over the trips of the last days: vendors that none of them can match go before the shuffle."""
    late = filters.after_cutoff(trips(spark, d), "startDate", LATE_CUTOFF)
    return aggregates.max_cost_by_vendor(late, vendors(spark, d), reduce_dims=True)


# --- layouts for lookups and conversions ---------------------------------------------

def clustered_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Orders range-clustered by key, then one key: the footers' minima and maxima exclude all but its file."""
    orders = read_table(spark, d, "orders")
    files = files_for(folder_size(spark, f"{d.rstrip('/')}/orders.parquet").bytes, LOOKUP_FILE_BYTES)
    path = write_lookup_table(orders, scratch_path(spark, "orders-by-key"), "o_orderkey", files=files)
    return filters.point_lookup(spark.read.schema(orders.schema).parquet(path), "o_orderkey", LOOKUP_ORDER_KEY)


def bloom_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Trips dealt over files without any order, with bloom filters of the id, then one id."""
    source = trips(spark, d)
    files = files_for(folder_size(spark, materialize(spark, d)[0]).bytes, LOOKUP_FILE_BYTES)
    path = write_lookup_table(source, scratch_path(spark, "trips-bloom"), "id", layout="bloom", files=files,
                              keys_per_row_group=LOOKUP_KEYS_PER_FILE)
    return trip_queries.lookup_trip(spark.read.schema(source.schema).parquet(path), LOOKUP_TRIP_ID)


def csv_to_even_parquet(spark: SparkSession, d: str) -> DataFrame:
    """Both CSV tables converted to evenly sized Parquet files clustered by id, and joined."""
    trips_csv, vendors_csv = scratch_path(spark, "trips-csv"), scratch_path(spark, "vendors-csv")
    write_csv_table(trips(spark, d), trips_csv)
    write_csv_table(vendors(spark, d), vendors_csv)
    t = convert_csv(spark, trips_csv, scratch_path(spark, "trips-even"), TRIP_SCHEMA, target_file_bytes=LOOKUP_FILE_BYTES,
                    cluster_by="id", timestamp_format=ROUND_TRIP_TIMESTAMP_FORMAT)
    v = convert_csv(spark, vendors_csv, scratch_path(spark, "vendors-even"), VENDOR_SCHEMA,
                    target_file_bytes=LOOKUP_FILE_BYTES, cluster_by="id")
    return _as_ntz(t.join(v, "id", "inner"))


# --- lines with faults -----------------------------------------------------------------

def _dirty_lines(spark: SparkSession, d: str) -> DataFrame:
    """The trips as lines, some of them damaged by fixed rules on the id, written and read back as text."""
    rows = trips(spark, d).select(*TRIP_COLUMNS)
    shown = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TRIP_COLUMNS}
    k = F.col("id")
    shown["startDate"] = F.when(k % 103 == 0, F.lit("yesterday")).otherwise(shown["startDate"])
    shown["cost"] = F.when(k % 101 == 0, F.lit("n/a")).otherwise(shown["cost"])
    whole = F.concat_ws(",", *shown.values())
    line = (F.when(k % 83 == 0, F.lit("")).when(k % 89 == 0, F.concat_ws(",", *list(shown.values())[:-1]))
            .when(k % 97 == 0, F.concat(whole, F.lit(",x"))).otherwise(whole))
    return read_text_lines(spark, write_result(rows.select(line.alias("value")), scratch_path(spark, "dirty-text"), "text"))


def text_bad_records(spark: SparkSession, d: str) -> DataFrame:
    """The bad-record channel of dirty lines, counted by kind of fault and column."""
    split = split_records(_dirty_lines(spark, d), TRIP_SCHEMA_NTZ, scratch_path(spark, "records"), nullable=True)
    return split.bad.groupBy("fault", "bad_column").agg(F.count(F.lit(1)).alias("lines"))


def text_good_records(spark: SparkSession, d: str) -> DataFrame:
    """The typed rows of the lines without a fault."""
    return split_records(_dirty_lines(spark, d), TRIP_SCHEMA_NTZ, scratch_path(spark, "records"), nullable=True).good


# --- sources and sinks ---------------------------------------------------------------

def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Both typed CSV tables, written, read back and joined."""
    trips_csv, vendors_csv = scratch_path(spark, "trips-csv"), scratch_path(spark, "vendors-csv")
    write_csv_table(trips(spark, d), trips_csv)
    write_csv_table(vendors(spark, d), vendors_csv)
    back = read_trips_csv(spark, trips_csv, timestamp_format=ROUND_TRIP_TIMESTAMP_FORMAT)
    return _as_ntz(back.join(read_vendors_csv(spark, vendors_csv), "id", "inner"))


def csv_to_parquet_round_trip(spark: SparkSession, d: str) -> DataFrame:
    trips_csv, vendors_csv = scratch_path(spark, "trips-csv"), scratch_path(spark, "vendors-csv")
    write_csv_table(trips(spark, d), trips_csv)
    write_csv_table(vendors(spark, d), vendors_csv)
    t = csv_to_parquet(spark, trips_csv, scratch_path(spark, "trips-parquet"), TRIP_SCHEMA,
                       timestamp_format=ROUND_TRIP_TIMESTAMP_FORMAT)
    v = csv_to_parquet(spark, vendors_csv, scratch_path(spark, "vendors-parquet"), VENDOR_SCHEMA)
    return _as_ntz(t.join(v, "id", "inner"))


def result_sink_csv(spark: SparkSession, d: str) -> DataFrame:
    result = trip_queries.max_trip_cost_per_vendor(trips(spark, d), vendors(spark, d))
    # one file per task: the number of vendors has no proven bound
    path = write_result(result, scratch_path(spark, "q2-csv"), "csv")
    return read_csv_table(spark, path, result.schema)


def result_sink_parquet(spark: SparkSession, d: str) -> DataFrame:
    """Q1 written as Parquet, its default format."""
    result = trip_queries.avg_trip_duration_per_hour(trips(spark, d))
    return spark.read.schema(result.schema).parquet(write_result(result, scratch_path(spark, "q1-parquet"), "parquet"))


def result_sink_top_k(spark: SparkSession, d: str) -> DataFrame:
    """Q3 (``k`` rows) written as one CSV file."""
    result = top_k_fastest(spark, d)
    path = write_result(result, scratch_path(spark, "q3-csv"), "csv", single_file=True)
    return read_csv_table(spark, path, result.schema)


def _text_copy(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df``'s rows as comma-separated lines (NULL → empty field) and
    read them back as text."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    path = write_result(df.select(F.concat_ws(",", *fields).alias("value")), scratch_path(spark, label), "text")
    return read_text_lines(spark, path)


def text_line_parse(spark: SparkSession, d: str) -> DataFrame:
    """Trips → text lines → typed rows by position, plus the start hour read
    straight from the raw line. Tolerant parsing keeps NULL fields as NULL."""
    lines = _text_copy(spark, trips(spark, d).select(*TRIP_COLUMNS), "trips-text")
    parsed = parse_lines(lines, TRIP_SCHEMA_NTZ, strict=False, keep_line=True)
    return parsed.select(*TRIP_COLUMNS, extract_start_hour(F.col("value")).alias("HourOfDay"))


def rdd_text_avg_duration_by_hour(spark: SparkSession, d: str) -> DataFrame:
    """Q1 from raw trip lines: hour text and whole-second timestamps read by position."""
    return line_queries.avg_duration_by_hour_from_lines(_text_copy(spark, trips(spark, d), "trips-text"))


def rdd_text_top_k_fastest(spark: SparkSession, d: str) -> DataFrame:
    """Q3 from raw lines through the strict record parser. A strict parser rejects an empty
    number, so NULL coordinates are written as ``NaN``, which the coordinate rules remove."""
    numbers = [f.name for f in TRIP_SCHEMA.fields if f.dataType == T.DoubleType()]
    rows = trips(spark, d).select(*TRIP_COLUMNS).withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in numbers})
    lines = _text_copy(spark, rows, "trips-text")
    pairs = parse_lines(_text_copy(spark, vendors(spark, d), "vendors-text"), VENDOR_SCHEMA)
    top = trip_queries.fastest_trips(parse_lines(lines, TRIP_SCHEMA), pairs, cutoff=TRIP_CUTOFF, variant="rdd")
    return top.select(_r("SpeedInMetersPerSec").alias("SpeedInMetersPerSec"), "VendorCompanyId")


def rdd_text_max_cost_by_vendor(spark: SparkSession, d: str) -> DataFrame:
    """Q2 from raw lines: trip ids joined as text, vendors ordered as text."""
    return line_queries.max_cost_by_vendor_from_lines(
        _text_copy(spark, trips(spark, d), "trips-text"), _text_copy(spark, vendors(spark, d), "vendors-text")
    )


def text_sink(spark: SparkSession, d: str) -> DataFrame:
    q1 = trip_queries.avg_trip_duration_per_hour(trips(spark, d))
    path = write_pair_lines(q1, "HourOfDay", "AverageTripDuration", scratch_path(spark, "q1-text"),
                            single_file=True)
    return read_text_lines(spark, path)


# --- the same shapes on the native tables -----------------------------------------------

def ship_lag_by_month(spark: SparkSession, d: str) -> DataFrame:
    lineitem = read_table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    joined = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"], "inner")
    return aggregates.avg_duration_by_bucket(
        joined,
        F.month("o_orderdate"),
        F.col("o_orderdate"),
        F.col("l_shipdate"),
        require_positive=True,
        scale=86400.0,
        key_alias="OrderMonth",
        value_alias="AverageShipLagDays",
        label=hour_label,
        max_buckets=13,  # months 1-12 plus NULL
    )


def max_price_by_brand(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.max_by_dimension(
        read_table(spark, d, "lineitem"),
        read_table(spark, d, "part"),
        fact_key="l_partkey",
        dim_key="p_partkey",
        value="l_extendedprice",
        attribute="p_brand",
        key_alias="Brand",
        value_alias="MaxExtendedPrice",
        preaggregate=True,  # part keys repeat in lineitem and are unique in part
    )


QUERIES: dict[str, Query] = {
    "point_lookup": point_lookup,
    "trip_point_lookup": trip_point_lookup,
    "avg_duration_by_hour": avg_duration_by_hour,
    "max_cost_by_vendor": max_cost_by_vendor,
    "valid_coordinates": valid_coordinates,
    "haversine_distance": haversine_distance,
    "trip_metrics": trip_metrics,
    "top_k_fastest": top_k_fastest,
    "rdd_avg_duration_by_hour": rdd_avg_duration_by_hour,
    "rdd_max_cost_by_vendor": rdd_max_cost_by_vendor,
    "rdd_top_k_fastest": rdd_top_k_fastest,
    "rdd_text_avg_duration_by_hour": rdd_text_avg_duration_by_hour,
    "rdd_text_top_k_fastest": rdd_text_top_k_fastest,
    "rdd_text_max_cost_by_vendor": rdd_text_max_cost_by_vendor,
    "trip_vendor_limited_join": trip_vendor_limited_join,
    "join_limited_dimension": join_limited_dimension,
    "join_strategy_broadcast": join_strategy_broadcast,
    "join_strategy_sort_merge": join_strategy_sort_merge,
    "join_strategy_report": join_strategy_report,
    "join_preview": join_preview,
    "join_run_report": join_run_report,
    "join_without_broadcast": join_without_broadcast,
    "late_max_cost_by_vendor": late_max_cost_by_vendor,
    "clustered_point_lookup": clustered_point_lookup,
    "bloom_point_lookup": bloom_point_lookup,
    "csv_to_even_parquet": csv_to_even_parquet,
    "text_bad_records": text_bad_records,
    "text_good_records": text_good_records,
    "csv_round_trip": csv_round_trip,
    "csv_to_parquet": csv_to_parquet_round_trip,
    "result_sink_csv": result_sink_csv,
    "result_sink_parquet": result_sink_parquet,
    "result_sink_top_k": result_sink_top_k,
    "text_line_parse": text_line_parse,
    "text_sink": text_sink,
    "ship_lag_by_month": ship_lag_by_month,
    "max_price_by_brand": max_price_by_brand,
}

"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver's ``events``/``orders``/... tables are pre-registered views; the
derived ``trips`` and ``vendors`` tables are rebuilt here as CTEs with the same
rules as :mod:`tripspark.sources.fixtures`. Column names match the Spark
results exactly. Trig results are rounded to 6 places on both sides (libm and
the JVM differ in the last ulp).
"""

from __future__ import annotations

from tripspark.plans.catalog import (
    LATE_CUTOFF,
    LIMITED_SUPPLIERS,
    LIMITED_VENDORS,
    LOOKUP_ORDER_KEY,
    LOOKUP_TRIP_ID,
    PREVIEW_ROWS,
    TRIP_CUTOFF,
)

R = 6


def _mulmod(k: str, factor: int, modulus: int) -> str:
    return f"((({k} % {modulus}) * {factor % modulus}) % {modulus})"


def _grid(k: str, factor: int, modulus: int, offset: float) -> str:
    return f"(CAST({_mulmod(k, factor, modulus)} AS DOUBLE) / CAST(100.0 AS DOUBLE) - CAST({offset} AS DOUBLE))"


def _unix(c: str) -> str:
    """Spark ``unix_timestamp`` on a zone-less timestamp."""
    return f"CAST(floor(epoch_us({c}) / 1000000) AS BIGINT)"


K = "event_id"
TRIPS_CTE = f"""trips AS (
  SELECT {K} AS id,
         ts AS startDate,
         ts + to_milliseconds(CASE WHEN {K} % 997 = 0 THEN 400
                                   ELSE {_mulmod(K, 37003, 7200000)} - 600000 END) AS endDate,
         CASE WHEN {K} % 113 = 0 THEN CAST(NULL AS DOUBLE)
              WHEN {K} % 101 = 0 THEN CAST(0.0 AS DOUBLE)
              ELSE {_grid(K, 7919, 36000, 180.0)} END AS startLon,
         CASE WHEN {K} % 103 = 0 THEN CAST(95.0 AS DOUBLE)
              ELSE {_grid(K, 104729, 18000, 90.0)} END AS startLat,
         CASE WHEN {K} % 107 = 0 THEN {_grid(K, 7919, 36000, 180.0)}
              ELSE {_grid(K, 15485863, 36000, 180.0)} END AS endLon,
         CASE WHEN {K} % 109 = 0 THEN {_grid(K, 104729, 18000, 90.0)}
              ELSE {_grid(K, 32452843, 18000, 90.0)} END AS endLat,
         value AS cost
  FROM events)"""

VENDORS_CTE = f"""vendors AS (
  SELECT {K} AS id, CAST(1 + {K} % 2 AS INTEGER) AS vendor FROM events WHERE {K} % 20 <> 0
  UNION ALL
  SELECT {K} AS id, CAST(3 AS INTEGER) AS vendor FROM events WHERE {K} % 211 = 0)"""

VALID = """startLon BETWEEN -180 AND 180 AND startLat BETWEEN -90 AND 90
    AND endLon BETWEEN -180 AND 180 AND endLat BETWEEN -90 AND 90
    AND startLon IS DISTINCT FROM 0.0 AND startLat IS DISTINCT FROM 0.0
    AND endLon IS DISTINCT FROM 0.0 AND endLat IS DISTINCT FROM 0.0"""
MOVED = "startLon <> endLon AND startLat <> endLat"

HAV_A = """(pow(sin((radians(endLat) - radians(startLat)) / 2.0), 2)
      + cos(radians(startLat)) * cos(radians(endLat)) * pow(sin((radians(endLon) - radians(startLon)) / 2.0), 2))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _metrics_cte(name: str, where: str, duration: str, guard: bool) -> str:
    """Cleaned trips with duration, a, c, distance and speed."""
    guard_sql = "WHERE a >= 0 AND a <= 1" if guard else ""
    return f"""{name}_a AS (
  SELECT id, {duration} AS durationInSec, {HAV_A} AS a
  FROM trips WHERE {where}),
{name} AS (
  SELECT id, durationInSec, a,
         atan2(sqrt(a), sqrt(1.0 - a)) * 2.0 AS c,
         (atan2(sqrt(a), sqrt(1.0 - a)) * 2.0) * 6371.0 AS distanceInMeters,
         ((atan2(sqrt(a), sqrt(1.0 - a)) * 2.0) * 6371.0) / NULLIF(CAST(durationInSec AS DOUBLE), 0.0)
           AS speedMetersPerSec
  FROM {name}_a {guard_sql})"""


DUR_S = f"({_unix('endDate')} - {_unix('startDate')})"
DUR_MS = "(CAST(epoch_ms(endDate) - epoch_ms(startDate) AS DOUBLE) / 1000.0)"


def _q1(require_positive: bool) -> str:
    where = "WHERE endDate > startDate" if require_positive else ""
    return _with(TRIPS_CTE) + f"""
SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS HourOfDay,
       CAST(sum(d) AS DOUBLE) / CAST(count(d) AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS AverageTripDuration
FROM (SELECT hour(startDate) AS h, {DUR_S} AS d FROM trips {where})
GROUP BY h ORDER BY 1"""


def _q2(vendor_key: str) -> str:
    return _with(TRIPS_CTE, VENDORS_CTE) + f"""
SELECT {vendor_key} AS VendorId, max(t.cost) AS MaxTripCost
FROM trips t JOIN vendors v ON t.id = v.id
GROUP BY 1 ORDER BY 1"""


TOP_K = _with(
    TRIPS_CTE,
    VENDORS_CTE,
    _metrics_cte(
        "parsed",
        f"{VALID} AND {MOVED} AND endDate > startDate AND startDate >= TIMESTAMP '{TRIP_CUTOFF}'",
        DUR_S,
        guard=True,
    ),
) + f"""
SELECT v.vendor AS VendorCompanyId, p.id AS TripId,
       round(p.speedMetersPerSec, {R}) AS SpeedInMetersPerSec,
       round(p.distanceInMeters, {R}) AS DistanceInMeters,
       p.durationInSec AS DurationInSec
FROM parsed p JOIN vendors v ON p.id = v.id
ORDER BY p.speedMetersPerSec DESC NULLS LAST, p.id, v.vendor
LIMIT 5"""

RDD_TOP_K = _with(
    TRIPS_CTE,
    VENDORS_CTE,
    _metrics_cte(
        "parsed",
        f"{VALID} AND endDate > startDate AND endDate > TIMESTAMP '{TRIP_CUTOFF}'",
        DUR_MS,
        guard=False,
    ),
) + f"""
SELECT round(p.speedMetersPerSec, {R}) AS SpeedInMetersPerSec, CAST(v.vendor AS BIGINT) AS VendorCompanyId
FROM parsed p JOIN vendors v ON p.id = v.id
ORDER BY p.speedMetersPerSec DESC NULLS LAST, p.id, v.vendor
LIMIT 5"""

SUPPLIER_JOIN = f"""
SELECT l.*, s.*
FROM lineitem l
JOIN (SELECT * FROM supplier ORDER BY s_suppkey LIMIT {LIMITED_SUPPLIERS}) s ON l.l_suppkey = s.s_suppkey"""

LINEITEM_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)

TRIP_COLUMNS = "id, startDate, endDate, startLon, startLat, endLon, endLat, cost"

TRIPS_AND_VENDORS = _with(TRIPS_CTE, VENDORS_CTE) + (
    "SELECT t.id, t.startDate, t.endDate, t.startLon, t.startLat, t.endLon, t.endLat, t.cost, v.vendor "
    "FROM trips t JOIN vendors v ON t.id = v.id")

DIRTY_CTE = f"""dirty AS (
  SELECT {TRIP_COLUMNS},
         CASE WHEN id % 83 = 0 THEN 'blank_line' WHEN id % 89 = 0 THEN 'missing_fields' WHEN id % 97 = 0 THEN 'extra_fields'
              WHEN id % 103 = 0 OR id % 101 = 0 THEN 'bad_field' END AS fault,
         CASE WHEN id % 103 = 0 THEN 'startDate' ELSE 'cost' END AS first_bad
  FROM trips)"""

SQL: dict[str, str] = {
    "point_lookup": f"SELECT * FROM orders WHERE o_orderkey = {LOOKUP_ORDER_KEY}",
    "trip_point_lookup": _with(TRIPS_CTE) + f"SELECT * FROM trips WHERE id = {LOOKUP_TRIP_ID}",
    "avg_duration_by_hour": _q1(True),
    "max_cost_by_vendor": _q2("v.vendor"),
    "valid_coordinates": _with(TRIPS_CTE) + f"SELECT * FROM trips WHERE {VALID} AND {MOVED}",
    "haversine_distance": _with(TRIPS_CTE, _metrics_cte("m", VALID + " AND " + MOVED, DUR_S, guard=False))
    + f"SELECT id, round(a, {R}) AS haversine_a, round(distanceInMeters, {R}) AS distance FROM m",
    "trip_metrics": _with(
        TRIPS_CTE, _metrics_cte("m", f"{VALID} AND {MOVED} AND endDate > startDate", DUR_S, guard=True)
    )
    + f"""SELECT id, durationInSec, round(a, {R}) AS a, round(c, {R}) AS c,
       round(distanceInMeters, {R}) AS distanceInMeters, round(speedMetersPerSec, {R}) AS speedMetersPerSec
FROM m""",
    "top_k_fastest": TOP_K,
    "rdd_avg_duration_by_hour": _q1(False),
    "rdd_max_cost_by_vendor": _q2("CAST(v.vendor AS VARCHAR)"),
    "rdd_top_k_fastest": RDD_TOP_K,
    "rdd_text_top_k_fastest": RDD_TOP_K,
    "rdd_text_avg_duration_by_hour": _q1(False),
    "rdd_text_max_cost_by_vendor": _q2("CAST(v.vendor AS VARCHAR)"),
    "trip_vendor_limited_join": _with(TRIPS_CTE, VENDORS_CTE)
    + "SELECT t.id, t.startDate, t.endDate, t.startLon, t.startLat, t.endLon, t.endLat, t.cost, v.vendor "
    f"FROM trips t JOIN (SELECT * FROM vendors ORDER BY id, vendor LIMIT {LIMITED_VENDORS}) v ON t.id = v.id",
    "join_limited_dimension": SUPPLIER_JOIN,
    "join_strategy_broadcast": SUPPLIER_JOIN,
    "join_strategy_sort_merge": SUPPLIER_JOIN,
    "join_strategy_report": f"""
WITH j AS ({SUPPLIER_JOIN})
SELECT 'broadcast' AS strategy, 'BroadcastHashJoin' AS join_operator, count(*) AS rows,
       CAST(sum(l_orderkey) AS BIGINT) AS measure_sum FROM j
UNION ALL
SELECT 'merge' AS strategy, 'SortMergeJoin' AS join_operator, count(*) AS rows,
       CAST(sum(l_orderkey) AS BIGINT) AS measure_sum FROM j""",
    "join_preview": f"SELECT * FROM ({SUPPLIER_JOIN}) ORDER BY {LINEITEM_ORDER} LIMIT {PREVIEW_ROWS}",
    "join_run_report": f"""
WITH j AS (SELECT count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS measure_sum FROM ({SUPPLIER_JOIN}))
SELECT 'auto' AS strategy, 'BroadcastHashJoin' AS planned_operator, 'BroadcastHashJoin' AS join_operator, rows, measure_sum FROM j
UNION ALL SELECT 'merge', 'SortMergeJoin', 'SortMergeJoin', rows, measure_sum FROM j
UNION ALL SELECT 'no_broadcast', 'SortMergeJoin', 'SortMergeJoin', rows, measure_sum FROM j""",
    "join_without_broadcast": SUPPLIER_JOIN,
    "late_max_cost_by_vendor": _with(TRIPS_CTE, VENDORS_CTE) + f"""
SELECT v.vendor AS VendorId, max(t.cost) AS MaxTripCost
FROM trips t JOIN vendors v ON t.id = v.id WHERE t.startDate >= TIMESTAMP '{LATE_CUTOFF}'
GROUP BY 1 ORDER BY 1""",
    "clustered_point_lookup": f"SELECT * FROM orders WHERE o_orderkey = {LOOKUP_ORDER_KEY}",
    "bloom_point_lookup": _with(TRIPS_CTE) + f"SELECT * FROM trips WHERE id = {LOOKUP_TRIP_ID}",
    "csv_to_even_parquet": TRIPS_AND_VENDORS,
    "text_bad_records": _with(TRIPS_CTE, DIRTY_CTE)
    + "SELECT fault, CASE WHEN fault = 'bad_field' THEN first_bad END AS bad_column, count(*) AS lines "
    "FROM dirty WHERE fault IS NOT NULL GROUP BY 1, 2",
    "text_good_records": _with(TRIPS_CTE, DIRTY_CTE) + f"SELECT {TRIP_COLUMNS} FROM dirty WHERE fault IS NULL",
    "csv_round_trip": TRIPS_AND_VENDORS,
    "csv_to_parquet": TRIPS_AND_VENDORS,
    "result_sink_csv": _q2("v.vendor"),
    "result_sink_parquet": _q1(True),
    "result_sink_top_k": TOP_K,
    "text_line_parse": _with(TRIPS_CTE)
    + f"SELECT {TRIP_COLUMNS}, substr(CAST(startDate AS VARCHAR), 12, 2) AS HourOfDay FROM trips",
    "text_sink": f"SELECT '(' || HourOfDay || ',' || CAST(AverageTripDuration AS VARCHAR) || ')' AS value "
    f"FROM ({_q1(True)})",
    "ship_lag_by_month": f"""
SELECT lpad(CAST(m AS VARCHAR), 2, '0') AS OrderMonth,
       CAST(sum(d) AS DOUBLE) / CAST(count(d) AS DOUBLE) / CAST(86400.0 AS DOUBLE) AS AverageShipLagDays
FROM (SELECT month(o.o_orderdate) AS m, {_unix('l.l_shipdate')} - {_unix('o.o_orderdate')} AS d
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      WHERE l.l_shipdate > o.o_orderdate)
GROUP BY m ORDER BY 1""",
    "max_price_by_brand": """
SELECT p.p_brand AS Brand, max(l.l_extendedprice) AS MaxExtendedPrice
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1 ORDER BY 1""",
}

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripspark.functions import (
    duration_millis,
    duration_seconds,
    epoch_millis,
    haversine_a,
    hour_label,
    hour_of_day,
    ieee_divide,
    speed,
)

from helpers import trip, trips_df

lon = st.floats(-180, 180, allow_nan=False)
lat = st.floats(-90, 90, allow_nan=False)


def test_hour_and_label(spark):
    df = trips_df(spark, [trip(1, "2015-03-10 05:00:00", "2015-03-10 05:10:00"),
                          trip(2, "2015-03-10 23:59:59.999", "2015-03-11 00:00:00")])
    out = df.select(hour_label(hour_of_day(F.col("startDate"))).alias("h"),
                    F.col("startDate").cast("string").substr(12, 2).alias("h_text")).collect()
    assert [r.h for r in out] == ["05", "23"]
    assert [r.h for r in out] == [r.h_text for r in out]


def test_durations_seconds_and_millis(spark):
    df = trips_df(spark, [trip(1, "2024-01-01 00:00:00.900", "2024-01-01 00:00:01.100"),
                          trip(2, "2024-01-01 00:00:00.1795", "2024-01-01 00:00:00.1801"),
                          trip(3, "2024-01-01 00:10:00", "2024-01-01 00:00:00")])
    out = df.select(duration_seconds(F.col("startDate"), F.col("endDate")).alias("s"),
                    duration_millis(F.col("startDate"), F.col("endDate"), True).alias("ms")).collect()
    # whole-second epochs are subtracted, not the exact difference
    assert [r.s for r in out] == [1, 0, -600]
    # floored millisecond epochs, like Date.getTime() differences
    assert [r.ms for r in out] == [200, 1, -600000]


def test_epoch_millis_ntz_and_session_zone_agree_in_utc(spark):
    df = trips_df(spark, [trip(1, "2024-01-01 00:00:07.179575", "2024-01-01 00:00:08")])
    r = df.select(epoch_millis(F.col("startDate"), True).alias("a"),
                  epoch_millis(F.col("startDate").cast("timestamp"), False).alias("b")).first()
    assert r.a == r.b == 1704067207179


def _distance_rows(spark, rows):
    df = spark.createDataFrame(rows, "slon double, slat double, elon double, elat double")
    return df.select(
        haversine_a(F.col("slon"), F.col("elon"), F.col("slat"), F.col("elat")).alias("a"),
        haversine_a(F.col("elon"), F.col("slon"), F.col("elat"), F.col("slat")).alias("a_rev"),
    ).collect()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(lon, lat, lon, lat), min_size=1, max_size=20))
def test_haversine_properties(spark, rows):
    for (slon, slat, elon, elat), r in zip(rows, _distance_rows(spark, rows)):
        assert -1e-12 <= r.a <= 1 + 1e-12
        assert abs(r.a - r.a_rev) <= 1e-12
        # python reference formula
        p1, p2 = math.radians(slat), math.radians(elat)
        a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
            (math.radians(elon) - math.radians(slon)) / 2) ** 2
        assert abs(a - r.a) <= 1e-12


def test_haversine_identical_points_and_antipodes(spark):
    r0, r1 = _distance_rows(spark, [(-73.9, 40.7, -73.9, 40.7), (0.1, 0.1, -179.9, -0.1)])
    assert r0.a == 0.0
    assert abs(r1.a - 1.0) < 1e-9


def test_speed_zero_division(spark):
    df = spark.createDataFrame([(5.0, 0), (0.0, 0), (-1.0, 0), (6.0, 2)], "d double, t long")
    null = [r.s for r in df.select(speed(F.col("d"), F.col("t")).alias("s")).collect()]
    assert null == [None, None, None, 3.0]
    ieee = [r.s for r in df.select(ieee_divide(F.col("d"), F.col("t")).alias("s")).collect()]
    assert ieee[0] == math.inf and math.isnan(ieee[1]) and ieee[2] == -math.inf and ieee[3] == 3.0

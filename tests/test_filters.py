import math

from tripspark.operators import filters

from helpers import trip, trips_df

S, E = "2015-03-10 05:00:00", "2015-03-10 05:10:00"


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_coordinate_rules(spark):
    rows = [
        trip(1, S, E),                              # normal: kept
        trip(2, S, E, slon=0.0),                    # zero: dropped
        trip(3, S, E, slon=None),                   # NULL: dropped
        trip(4, S, E, slon=math.nan),               # NaN: dropped
        trip(5, S, E, slon=180.0, elon=179.0),      # bound inclusive: kept
        trip(6, S, E, slon=180.1),                  # out of range: dropped
        trip(7, S, E, elon=-73.9),                  # due north (no lon move): dropped
        trip(8, S, E, elat=40.7),                   # due east (no lat move): dropped
        trip(9, S, E, slat=95.0),                   # lat out of range
    ]
    df = trips_df(spark, rows)
    assert ids(filters.valid_coordinates(df)) == [1, 5]
    # without the moved check, due-north/east trips stay
    assert ids(filters.valid_coordinates(df, require_moved=False)) == [1, 5, 7, 8]


def test_positive_duration_and_cutoff(spark):
    df = trips_df(spark, [
        trip(1, "2015-03-10 00:00:00", "2015-03-10 00:10:00"),   # start exactly at cutoff
        trip(2, "2015-03-09 23:59:00", "2015-03-10 00:10:00"),   # start before, end after
        trip(3, "2015-03-10 01:00:00", "2015-03-10 01:00:00"),   # end = start
        trip(4, "2015-03-10 01:00:00", "2015-03-10 00:59:00"),   # end < start
    ])
    assert ids(filters.positive_duration(df)) == [1, 2]
    cut = "2015-03-10 00:00:00"
    assert ids(filters.after_cutoff(df, "startDate", cut, inclusive=True)) == [1, 3, 4]
    assert ids(filters.after_cutoff(df, "endDate", cut, inclusive=False)) == [1, 2, 3, 4]


def test_point_lookup_pushed_to_scan(spark):
    from conftest import SF_SMALL

    df = filters.point_lookup(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), "o_orderkey", 42)
    from tripspark.plans.explain import explain_text

    plan = explain_text(df)
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,42)]" in plan


def test_coordinate_filters_pushed_to_scan(spark, tmp_path):
    df = trips_df(spark, [trip(1, S, E)])
    df.write.parquet(str(tmp_path / "t"))
    back = filters.valid_coordinates(spark.read.parquet(str(tmp_path / "t")))
    from tripspark.plans.explain import explain_text

    plan = explain_text(back)
    assert "GreaterThanOrEqual(startLon,-180.0)" in plan and "Not(EqualNullSafe(startLon,0.0))" in plan

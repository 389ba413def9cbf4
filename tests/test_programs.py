import os

import pytest
from pyspark.sql import functions as F

from tripspark.plans import line_queries, programs
from tripspark.sources import read_text_lines

LINES = [
    "1,2015-03-10 05:00:00,2015-03-10 05:10:00,-73.9,40.7,-73.8,40.8,12.5",
    "2,2015-03-10 05:30:00.7,2015-03-10 05:50:00.2,-73.95,40.75,-73.7,40.9,30.0",
    "3,2015-03-10 06:00:00,2015-03-10 05:00:00,-73.9,40.7,-73.8,40.8,7.0",
    "4,2015-03-11 07:00:00,2015-03-11 07:00:02,-73.9,40.7,-73.0,41.8,99.0",
]
VENDOR_LINES = ["1,2", "2,10", "3,2", "4,10", "4,2"]


@pytest.fixture()
def inputs(tmp_path):
    t = tmp_path / "trips.csv"
    t.write_text("\n".join(LINES) + "\n")
    v = tmp_path / "vendors.csv"
    v.write_text("\n".join(VENDOR_LINES) + "\n")
    return str(t), str(v), tmp_path


def test_line_queries(spark, inputs):
    t, v, _ = inputs
    tl, vl = read_text_lines(spark, t), read_text_lines(spark, v)
    q1 = [tuple(r) for r in line_queries.avg_duration_by_hour_from_lines(tl).collect()]
    # fractions are ignored: 05:30:00 -> 05:50:00 is 1200 s
    assert q1 == [("05", 0.9), ("06", -3.6), ("07", 0.002)]
    q2 = [tuple(r) for r in line_queries.max_cost_by_vendor_from_lines(tl, vl).collect()]
    assert q2 == [("10", 99.0), ("2", 99.0)]


def test_line_query_strict_parse(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("1,garbage,2015-03-10 05:10:00,1,1,2,2,1\n")
    with pytest.raises(Exception):
        line_queries.avg_duration_by_hour_from_lines(read_text_lines(spark, str(p))).collect()


def test_dataframe_program_csv_and_parquet(spark, inputs):
    t, v, tmp = inputs
    run = programs.run_dataframe_program(spark, t, v, str(tmp / "res"))
    assert set(run.outputs) == {"Q1", "Q2", "Q3"} and all(x >= 0 for x in run.seconds.values())
    q2 = spark.read.csv(run.outputs["Q2"], schema="VendorId int, MaxTripCost double").collect()
    assert sorted(tuple(r) for r in q2) == [(2, 99.0), (10, 99.0)]
    runp = programs.run_dataframe_program(spark, t, v, str(tmp / "resp"), parquet_trips=str(tmp / "tp"),
                                          parquet_vendors=str(tmp / "vp"))
    assert runp.outputs["Q1"].endswith("/Q1_results.parquet") and "convert" in runp.seconds
    q3 = spark.read.parquet(runp.outputs["Q3"]).orderBy(F.col("SpeedInMetersPerSec").desc()).collect()
    assert [r.TripId for r in q3][:2] == [4, 4]     # two vendors for trip 4
    assert os.path.isdir(runp.outputs["Q3"])


def test_text_program(spark, inputs):
    t, v, tmp = inputs
    run = programs.run_text_program(spark, t, v, str(tmp / "txt"))
    assert run.outputs["Q2"].endswith("/Q2_results")
    q2 = sorted(r.value for r in spark.read.text(run.outputs["Q2"]).collect())
    assert q2 == ["(10,99.0)", "(2,99.0)"]
    q1 = [r.value for r in spark.read.text(run.outputs["Q1"]).collect()]
    assert q1[0] == "(05,0.9)"
    # trip 3 ends before it starts; trip 4 has two vendors
    assert len(spark.read.text(run.outputs["Q3"]).collect()) == 4


def test_join_program(spark, inputs):
    t, v, tmp = inputs
    programs.run_dataframe_program(spark, t, v, str(tmp / "r"), parquet_trips=str(tmp / "tp"),
                                   parquet_vendors=str(tmp / "vp"))
    run = programs.run_join_program(spark, str(tmp / "tp"), str(tmp / "vp"), n=3)
    assert run.outputs == {"broadcast": "BroadcastHashJoin", "merge": "SortMergeJoin"}
    assert run.frames["broadcast"].columns.count("id") == 1
    assert sorted(map(tuple, run.frames["broadcast"].collect())) == sorted(map(tuple, run.frames["merge"].collect()))


def test_dataframe_program_on_derived_trips_matches_the_queries(spark, tmp_path):
    """Trips written as CSV with the fraction-less pattern, run through the
    whole program (with Parquet conversion), give the same Q1/Q2/Q3 as the
    typed queries over the same trips truncated to whole seconds (the pattern
    drops fractions, so a sub-second trip becomes end == start)."""
    from conftest import SF_SMALL
    from tripspark.plans import trip_queries as Q
    from tripspark.sinks import write_csv_table
    from tripspark.sources import REFERENCE_TIMESTAMP_FORMAT, trips, vendors

    t, v = trips(spark, SF_SMALL), vendors(spark, SF_SMALL)
    tc = write_csv_table(t, str(tmp_path / "trips_csv"), timestamp_format=REFERENCE_TIMESTAMP_FORMAT)
    vc = write_csv_table(v, str(tmp_path / "vendors_csv"))
    run = programs.run_dataframe_program(spark, tc, vc, str(tmp_path / "res"), parquet_trips=str(tmp_path / "tp"),
                                         parquet_vendors=str(tmp_path / "vp"), cutoff="2024-01-10 00:00:00")
    from pyspark.sql import functions as F

    t = t.withColumns({c: F.date_trunc("second", F.col(c)) for c in ("startDate", "endDate")})
    q1 = sorted(map(tuple, spark.read.parquet(run.outputs["Q1"]).collect()))
    assert q1 == sorted(map(tuple, Q.avg_trip_duration_per_hour(t).collect()))
    q2 = sorted(map(tuple, spark.read.parquet(run.outputs["Q2"]).collect()))
    assert q2 == sorted(map(tuple, Q.max_trip_cost_per_vendor(t, v).collect()))
    q3 = spark.read.parquet(run.outputs["Q3"]).collect()
    want = Q.fastest_trips(t, v, cutoff="2024-01-10 00:00:00").collect()
    assert sorted(map(tuple, q3)) == sorted(map(tuple, want)) and len(want) == 5

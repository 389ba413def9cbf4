import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripspark.schemas import TRIP_SCHEMA_NTZ, VENDOR_SCHEMA
from tripspark.sinks import csv_to_parquet, pair_lines, write_csv_table, write_pair_lines
from tripspark.sources import (
    extract_start_hour,
    extract_trip_id,
    extract_vendor_id,
    line_field,
    parse_trip_lines,
    parse_vendor_lines,
    read_text_lines,
    read_trips_csv,
    read_vendors_csv,
)

from helpers import trip, trips_df

CSV_LINES = [
    "1,2015-03-10 05:00:00,2015-03-10 05:10:00,-73.9,40.7,-73.8,40.8,12.5",   # normal
    "x2,2015-03-10 05:00:00,2015-03-10 05:10:00,-73.9,40.7,-73.8,40.8,1.0",   # bad long
    "3,not-a-time,2015-03-10 05:10:00,-73.9,40.7,-73.8,40.8,1.0",             # bad timestamp
    "4,2015-03-10 05:00:00,2015-03-10 05:10:00",                              # short row
    "5,2015-03-10 05:00:00,2015-03-10 05:10:00,-73.9,40.7,-73.8,40.8,1.0,99",  # extra field
    "",                                                                        # blank line
    "6,2015-03-10 06:00:00.5,2015-03-10 06:10:00,-73.9,40.7,-73.8,40.8,1.0",   # fraction
]


def test_csv_permissive_rules(spark, tmp_path):
    p = tmp_path / "trips.csv"
    p.write_text("\n".join(CSV_LINES) + "\n")
    rows = read_trips_csv(spark, str(p), schema=TRIP_SCHEMA_NTZ).collect()
    assert len(rows) == 6                                # blank line skipped
    by_pos = {i: r for i, r in enumerate(rows)}
    assert by_pos[0].cost == 12.5 and by_pos[0].startDate == dt.datetime(2015, 3, 10, 5)
    assert by_pos[1].id is None                          # bad field -> NULL
    assert by_pos[2].startDate is None
    assert by_pos[3].startLon is None and by_pos[3].cost is None   # short row padded
    assert by_pos[4].id == 5 and by_pos[4].cost == 1.0   # extra field dropped
    assert by_pos[5].startDate is None                   # fraction with a fraction-less pattern
    frac = read_trips_csv(spark, str(p), schema=TRIP_SCHEMA_NTZ,
                          timestamp_format="yyyy-MM-dd HH:mm:ss[.SSSSSS]").collect()
    assert frac[5].startDate == dt.datetime(2015, 3, 10, 6, 0, 0, 500000)


def test_csv_failfast(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text(CSV_LINES[1] + "\n")
    with pytest.raises(Exception):
        read_trips_csv(spark, str(p), mode="FAILFAST").collect()


def test_vendor_csv(spark, tmp_path):
    p = tmp_path / "v.csv"
    p.write_text("1,2\n2,10\n")
    assert [tuple(r) for r in read_vendors_csv(spark, str(p)).collect()] == [(1, 2), (2, 10)]


def test_text_line_parsing(spark, tmp_path):
    p = tmp_path / "lines.txt"
    p.write_text(CSV_LINES[0] + "\n" + "7,2015-03-10 07:00:00.25,2015-03-10 07:10:00,1.5,2.5,3.5,4.5,9.0\n")
    lines = read_text_lines(spark, str(p))
    parsed = parse_trip_lines(lines, schema=TRIP_SCHEMA_NTZ).collect()
    assert parsed[1].startDate == dt.datetime(2015, 3, 10, 7, 0, 0, 250000)
    fields = lines.select(extract_start_hour(F.col("value")).alias("h"), extract_trip_id(F.col("value")).alias("i"),
                          line_field(F.col("value"), 7).cast("double").alias("c")).collect()
    assert [(r.h, r.i, r.c) for r in fields] == [("05", "1", 12.5), ("07", "7", 9.0)]
    vp = tmp_path / "v.txt"
    vp.write_text("1,2\n")
    vl = read_text_lines(spark, str(vp))
    assert vl.select(extract_vendor_id(F.col("value"))).first()[0] == "2"
    assert tuple(parse_vendor_lines(vl).first()) == (1, 2)


def test_text_parse_strict_fails_on_bad_token(spark, tmp_path):
    p = tmp_path / "bad.txt"
    p.write_text(CSV_LINES[1] + "\n")
    lines = read_text_lines(spark, str(p))
    with pytest.raises(Exception):
        parse_trip_lines(lines).collect()
    with pytest.raises(Exception):
        parse_trip_lines(read_text_lines(spark, str(p)).select(F.lit("1,2").alias("value"))).collect()
    tolerant = parse_trip_lines(lines, strict=False).first()
    assert tolerant.id is None and tolerant.cost == 1.0


def test_strict_parsing_survives_column_pruning(spark):
    from tripspark.plans import trip_queries

    good = "1,2015-03-10 05:00:00,2015-03-10 05:10:00,1.0,2.0,3.0,4.0,{}"
    bad_cost = spark.createDataFrame([(good.format("XX"),)], "value string")
    vendors = parse_vendor_lines(spark.createDataFrame([("1,2",)], "value string"))
    with pytest.raises(Exception, match="cannot parse cost"):
        parse_trip_lines(bad_cost).select("id").collect()
    with pytest.raises(Exception, match="cannot parse cost"):
        trip_queries.fastest_trips(parse_trip_lines(bad_cost), vendors, cutoff="2015-01-01 00:00:00", variant="rdd").collect()
    short = spark.createDataFrame([("7,2015-03-10 05:00:00",)], "value string")
    with pytest.raises(Exception, match="missing fields"):
        parse_trip_lines(short).select("id").collect()


def test_tolerant_short_lines_and_literal_delimiters(spark):
    short = spark.createDataFrame([("7",), ("8,2",)], "value string")
    assert [tuple(r) for r in parse_vendor_lines(short, strict=False).collect()] == [(7, None), (8, 2)]
    assert parse_trip_lines(short, strict=False).where("cost is null").count() == 2
    piped = spark.createDataFrame([("12|3",)], "value string")
    assert tuple(parse_vendor_lines(piped, sep="|").first()) == (12, 3)
    assert piped.select(line_field(F.col("value"), 0, "|"), line_field(F.col("value"), 5, "|")).first()[:] == ("12", None)


def test_csv_round_trip_and_parquet_conversion(spark, tmp_path):
    df = trips_df(spark, [trip(1, "2024-01-01 00:00:07.179575", "2024-01-01 00:10:00", slon=None),
                          trip(2, "2024-01-01 00:00:00", "2024-01-01 00:00:00.5", cost=1e-7)])
    path = write_csv_table(df, str(tmp_path / "csv"))
    back = read_trips_csv(spark, path, schema=TRIP_SCHEMA_NTZ, timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert sorted(back.collect()) == sorted(df.collect())
    pq = csv_to_parquet(spark, path, str(tmp_path / "pq"), TRIP_SCHEMA_NTZ,
                        timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert "parquet" in pq.inputFiles()[0] or pq.inputFiles()[0].endswith(".parquet")
    assert sorted(pq.collect()) == sorted(df.collect())
    v = spark.createDataFrame([(1, 3)], VENDOR_SCHEMA)
    vp = write_csv_table(v, str(tmp_path / "vcsv"))
    assert read_vendors_csv(spark, vp).collect() == v.collect()


def test_pair_lines_single_file(spark, tmp_path):
    df = spark.createDataFrame([("05", 1.5), ("06", None)], "k string, v double").orderBy("k")
    assert [r.value for r in pair_lines(df, "k", "v").collect()] == ["(05,1.5)", "(06,null)"]
    path = write_pair_lines(df, "k", "v", str(tmp_path / "out"))
    parts = [f for f in (tmp_path / "out").iterdir() if f.name.startswith("part-")]
    assert len(parts) == 1
    assert parts[0].read_text().splitlines() == ["(05,1.5)", "(06,null)"]
    # overwrite replaces the previous output
    write_pair_lines(df.limit(1), "k", "v", path)
    assert [r.value for r in read_text_lines(spark, path).collect()] == ["(05,1.5)"]


def test_csv_dropmalformed_and_bad_mode(spark, tmp_path):
    p = tmp_path / "mixed.csv"
    p.write_text("\n".join(CSV_LINES) + "\n")
    kept = read_trips_csv(spark, str(p), schema=TRIP_SCHEMA_NTZ, mode="DROPMALFORMED").collect()
    # every malformed row is dropped — bad long, bad timestamp, short row,
    # unparsable fraction, and (unlike PERMISSIVE) the row with an extra field
    assert sorted(r.id for r in kept) == [1]
    with pytest.raises(ValueError):
        read_trips_csv(spark, str(p), mode="LENIENT")


def test_shared_dir_never_machine_local_on_a_cluster():
    from tripspark.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError):
        shared_dir(Session())

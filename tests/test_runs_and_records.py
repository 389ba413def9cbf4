"""Joins reported from the plan that ran, sessions with settings of their own, and the two channels of lines."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.operators import joins
from tripspark.plans import explain, programs
from tripspark.session import NO_BROADCAST, session_with
from tripspark.sources import classified_lines, read_text_lines, split_records


def test_report_names_the_operator_that_ran(spark, tmp_path):
    """The filter's estimate is far off: planned as a sort-merge join, run as a broadcast join."""
    session = session_with(spark, {"spark.sql.autoBroadcastJoinThreshold": "64k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "64k"})
    spark.range(200_000).select("id", (F.col("id") % 7).alias("v")).write.parquet(str(tmp_path / "facts"))
    spark.range(100_000).select("id", F.md5(F.col("id").cast("string")).alias("name")).write.parquet(str(tmp_path / "dims"))
    facts = session.read.parquet(str(tmp_path / "facts"))
    dims = session.read.parquet(str(tmp_path / "dims")).where(F.col("name").startswith("0000"))
    joined = facts.join(dims, "id")
    ran = explain.run_join(joined, "auto", order=["id"], measure="v", preview_rows=2)
    assert (ran.planned, ran.executed) == ("SortMergeJoin", "BroadcastHashJoin")
    assert ran.rows == joined.count() and ran.measure_sum == joined.agg(F.sum("v")).first()[0]
    assert ran.seconds > 0 and len(ran.preview) == min(2, ran.rows)
    merge = explain.run_join(joins.join_with_strategy(facts, dims, "id", strategy="merge"), "merge", order=["id"])
    assert (merge.planned, merge.executed, merge.rows, merge.measure_sum) == ("SortMergeJoin", "SortMergeJoin", ran.rows, None)
    report = explain.join_runs_report(spark, [ran, merge]).collect()
    assert [(r.strategy, r.planned_operator, r.join_operator) for r in report] == [
        ("auto", "SortMergeJoin", "BroadcastHashJoin"), ("merge", "SortMergeJoin", "SortMergeJoin")]
    assert all(r.seconds > 0 for r in report)


def test_plan_before_and_after_the_action(spark):
    joined = spark.range(100).join(F.broadcast(spark.range(5)), "id")
    assert explain.executed_joins(joined) == explain.planned_joins(joined) == ["BroadcastHashJoin"]
    joined.collect()
    assert "== Final Plan ==" in explain.executed_plan(joined) and "== Initial Plan ==" not in explain.executed_plan(joined)


def test_one_definition_under_two_settings(spark):
    def build(session):
        return session.range(1000).join(session.range(10), "id")

    before = dict(spark.conf.getAll)
    other = session_with(spark, NO_BROADCAST)
    plain, ruled_out = build(spark), build(other)
    assert explain.planned_joins(plain) == ["BroadcastHashJoin"]
    assert explain.planned_joins(ruled_out) == ["SortMergeJoin"]
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, ruled_out.collect()))
    assert explain.executed_joins(ruled_out) == ["SortMergeJoin"]
    assert dict(spark.conf.getAll) == before
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"):
        assert other.conf.get(key) == spark.conf.get(key)


@pytest.mark.parametrize("ordered", [True, False])
def test_join_program_reports_runs(spark, tmp_path, ordered):
    spark.range(500).select("id", (F.col("id") * 2.0).alias("cost")).write.parquet(str(tmp_path / "t"))
    spark.range(50).select("id", F.lit(1).alias("vendor")).write.parquet(str(tmp_path / "v"))
    run = programs.run_join_program(spark, str(tmp_path / "t"), str(tmp_path / "v"), n=10, ordered=ordered, by_settings=True)
    assert run.outputs == {"broadcast": "BroadcastHashJoin", "merge": "SortMergeJoin", "no_broadcast": "SortMergeJoin"}
    report = {r.strategy: r for r in run.frames["report"].collect()}
    assert {r.rows for r in report.values()} == {10} and len({r.measure_sum for r in report.values()}) == 1
    assert all(run.seconds[k] == report[k].seconds > 0 for k in report)
    assert run.frames["merge_preview"].count() == 10


# --- lines ------------------------------------------------------------------------------------

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType()), T.StructField("v", T.DoubleType())])
LINES = ["1,2024-01-01 00:00:00,1.5", "", "   ", "2,2024-01-01 00:00:00", "3,2024-01-01 00:00:00,2.5,extra", "x,2024-01-01 00:00:00,3",
         "4,yesterday,oops", "5,,6", "6,2024-01-01 00:00:00,NaN", "7,2024-01-01 00:00:00,1e400x", "1,2024-01-01 00:00:00,1.5",
         "9" * 40 + ",2024-01-01 00:00:00,1"]


def _lines(spark, tmp_path):
    (tmp_path / "in.txt").write_text("\n".join(LINES) + "\n")
    return read_text_lines(spark, str(tmp_path / "in.txt"))


def test_lines_are_classified(spark, tmp_path):
    got = {r.line: (r.fault, r.bad_column, r.record is None) for r in classified_lines(_lines(spark, tmp_path), SCHEMA).collect()}
    assert got[LINES[0]] == (None, None, False) and got[LINES[8]] == (None, None, False)
    assert got[""] == got["   "] == ("blank_line", None, True)
    assert got[LINES[3]] == ("missing_fields", None, True) and got[LINES[4]] == ("extra_fields", None, True)
    assert got[LINES[5]] == ("bad_field", "id", True) and got[LINES[6]] == ("bad_field", "at", True)
    assert got[LINES[7]] == ("bad_field", "at", True) and got[LINES[9]] == ("bad_field", "v", True)
    assert got[LINES[11]] == ("bad_field", "id", True)
    loose = {r.line: r.fault for r in classified_lines(_lines(spark, tmp_path), SCHEMA, nullable=True).collect()}
    assert loose["5,,6"] is None


def test_both_channels_in_one_pass(spark, tmp_path):
    split = split_records(_lines(spark, tmp_path), SCHEMA, str(tmp_path / "out"))
    assert split.counts == {"good": 3, "blank_line": 2, "missing_fields": 1, "extra_fields": 1, "bad_field": 5}
    assert [f.name for f in split.good.schema] == ["id", "at", "v"] and split.good.schema["v"].dataType == T.DoubleType()
    assert sorted(r.id for r in split.good.collect()) == [1, 1, 6]
    assert sorted(r.line for r in split.bad.collect()) == sorted(x for i, x in enumerate(LINES) if i not in (0, 8, 10))


def test_channels_of_clean_and_empty_input(spark, tmp_path):
    (tmp_path / "in.txt").write_text("")
    split = split_records(read_text_lines(spark, str(tmp_path / "in.txt")), SCHEMA, str(tmp_path / "out"))
    assert sum(split.counts.values()) == 0 and split.good.count() == 0 and split.bad.count() == 0
    (tmp_path / "in2.txt").write_text(LINES[0] + "\n")
    split = split_records(read_text_lines(spark, str(tmp_path / "in2.txt")), SCHEMA, str(tmp_path / "out2"))
    assert split.counts["good"] == 1 and split.bad.count() == 0


def test_records_are_cast_once(spark, tmp_path):
    plan = explain.explain_text(classified_lines(_lines(spark, tmp_path), SCHEMA), "extended")
    optimised = plan[plan.index("== Optimized Logical Plan =="):plan.index("== Physical Plan ==")]
    assert optimised.count("try_cast") + optimised.lower().count("cast(") <= 2 * len(SCHEMA.fields) + 2

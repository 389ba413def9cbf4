"""Plan-shape checks over every registered query (the scale properties)."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tripspark.plans.catalog import QUERIES
from tripspark.plans.explain import explain_text

# queries that write and re-read a copy: their returned plan scans the copy
ROUND_TRIPS = {"csv_round_trip", "csv_to_parquet", "result_sink_csv", "result_sink_parquet", "result_sink_top_k", "text_line_parse", "text_sink",
               "rdd_text_avg_duration_by_hour", "rdd_text_max_cost_by_vendor", "clustered_point_lookup", "bloom_point_lookup",
               "csv_to_even_parquet", "text_bad_records", "text_good_records"}
# rows of finished runs, a few per strategy
FINISHED = {"join_run_report"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_join_and_no_python(spark, name):
    plan = explain_text(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # no Python UDFs / pandas UDFs anywhere in the hot path
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


# top-k queries return the checkpointed k rows (checked separately below)
CHECKPOINTED = {"rdd_text_top_k_fastest", "top_k_fastest", "rdd_top_k_fastest"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROUND_TRIPS - CHECKPOINTED - FINISHED))
def test_scans_are_pruned(spark, name):
    plan = explain_text(E.queries()[name](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas, plan
    full = {"events": 6, "lineitem": 11, "orders": 6}
    for cols in schemas:
        n = len(cols.split(","))
        # never every column of the wide driver tables unless the query returns them all
        if name not in ("point_lookup", "join_limited_dimension", "join_strategy_broadcast",
                        "join_strategy_sort_merge", "join_without_broadcast", "join_preview", "valid_coordinates"):
            assert n < max(full.values()), (name, cols)


def test_large_scale_shape_of_q2_reuses_the_key_partitioning(spark):
    """With broadcasting ruled out (as for a 100 TB vendor table) the
    join has one exchange per side, right below it, so adaptive execution can
    split a hot key on either."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = explain_text(E.queries()["max_cost_by_vendor"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "SortMergeJoin" in plan
    key_exchanges = re.findall(r"Arguments: hashpartitioning\(_k#\d+L, \d+\)", plan)
    assert len(key_exchanges) == 2      # one per side
    tree = plan.split("\n\n")[0]
    assert tree.count("HashAggregate") == 2   # partial+final after the join
    assert tree.count("Exchange") == 4        # key ×2, vendor groups, final order


def test_top_k_scans_without_shuffling_the_tables(spark):
    plan = explain_text(E.queries()["top_k_fastest"](spark, SF_SMALL))
    # the returned frame reads the checkpointed k rows
    assert "Exchange" not in plan and "SortMergeJoin" not in plan


# The supplier side holds strings: no bound, no hint.
BOUNDED_BROADCASTS = {"trip_vendor_limited_join"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_broadcasts_only_bounded_sides_at_scale(spark, name):
    """With statistics-based broadcasts ruled out (as for 100 TB tables), the
    only broadcasts left are hinted ones over a truncated (top-n) dimension."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = explain_text(E.queries()[name](spark, SF_SMALL)).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    lines = tree.splitlines()
    broadcasts = [i for i, ln in enumerate(lines) if "BroadcastExchange" in ln]
    if name not in BOUNDED_BROADCASTS:
        assert not broadcasts, tree
        return
    assert broadcasts, tree
    for i in broadcasts:
        depth = len(lines[i]) - len(lines[i].lstrip(" :|+-"))
        below = []
        for ln in lines[i + 1:]:
            if len(ln) - len(ln.lstrip(" :|+-")) <= depth:
                break
            below.append(ln)
        assert any("TakeOrderedAndProject" in ln for ln in below), tree

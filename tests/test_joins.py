import pytest
from pyspark.sql import functions as F

from tripspark.operators import joins
from tripspark.plans import explain

from conftest import SF_SMALL


def tables(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    sup = joins.limited_dimension(spark.read.parquet(f"{SF_SMALL}/supplier.parquet"), "s_suppkey", 5)
    return li, sup, li["l_suppkey"] == sup["s_suppkey"]


@pytest.mark.parametrize(
    "strategy,operator",
    [("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin")],
)
def test_strategy_picks_operator(spark, strategy, operator):
    li, sup, on = tables(spark)
    j = joins.join_with_strategy(li, sup, on, strategy=strategy, dim_max_rows=5)
    assert explain.join_operator_of(j) == operator


def test_strategies_return_the_same_bag(spark):
    li, sup, on = tables(spark)
    bags = []
    for s in ("auto", "broadcast", "merge", "shuffle_hash"):
        j = joins.join_with_strategy(li, sup, on, strategy=s, dim_max_rows=5)
        bags.append(sorted(tuple(r) for r in j.collect()))
    assert all(b == bags[0] for b in bags) and len(bags[0]) > 0


def test_merge_hint_survives_adaptive_execution(spark):
    li, sup, on = tables(spark)
    j = joins.join_with_strategy(li, sup, on, strategy="merge")
    assert len(j.collect()) > 0
    final = explain.explain_text(j)
    assert "isFinalPlan=true" in final and "SortMergeJoin" in final and "BroadcastHashJoin" not in final


def test_broadcast_needs_a_size_bound(spark):
    li, sup, _ = tables(spark)
    assert not joins.fits_broadcast(sup, None)
    assert joins.fits_broadcast(sup.select("s_suppkey", "s_acctbal"), 5)
    assert not joins.fits_broadcast(li, 10**9)
    # unbounded side: no hint, planner/AQE decide
    plain = joins.bounded_broadcast(li, None)
    assert plain is li


def test_report(spark):
    li, sup, on = tables(spark)
    rep = explain.join_strategy_report(li, sup, on, dim_max_rows=5, measure="l_orderkey").collect()
    got = {r.strategy: r for r in rep}
    assert got["broadcast"].join_operator == "BroadcastHashJoin"
    assert got["merge"].join_operator == "SortMergeJoin"
    assert got["broadcast"].rows == got["merge"].rows and got["broadcast"].measure_sum == got["merge"].measure_sum


def test_limited_dimension_is_deterministic(spark):
    sup = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    keys = [r.s_suppkey for r in joins.limited_dimension(sup, "s_suppkey", 3).collect()]
    assert keys == sorted(r.s_suppkey for r in sup.select("s_suppkey").collect())[:3]


def test_plain_join_hot_key_is_split_by_adaptive_execution(spark):
    """Joins whose inputs are plain shuffles (lineitem ⋈ orders, the sort-merge
    strategy, the top-k fallback) rely on adaptive skew-join splitting."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    prev = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        # key 0 holds a third of the fact rows
        facts = spark.range(0, 30000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                             F.col("id").alias("v"))
        dims = spark.range(0, 30000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("a"))
        j = facts.join(dims, "k")
        assert j.count() == 30000 - 10000 + 10000
        rows = j.collect()
        assert len(rows) == 30000
        final = explain.explain_text(j)
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_variable_width_side_gets_no_hint(spark):
    small = spark.createDataFrame([(1, "a" * 10), (2, "b" * 10)], "k long, s string")
    assert not joins.is_fixed_width(small.schema) and not joins.fits_broadcast(small, 2, max_bytes=1_000)
    assert joins.bounded_broadcast(small, 2, max_bytes=1_000_000) is small
    fixed = small.select("k")
    assert joins.fits_broadcast(fixed, 2, max_bytes=1_000) and not joins.fits_broadcast(fixed, 2, max_bytes=10)


def test_broadcast_budget_reads_size_strings(spark):
    assert [joins.byte_size(x) for x in ("10485760", "10485760b", "50MB", "1g", "-1", "256k")] == [
        10 << 20, 10 << 20, 50 << 20, 1 << 30, -1, 256 << 10]
    key, fixed = "spark.sql.autoBroadcastJoinThreshold", spark.range(3)
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "50MB")
        assert joins.broadcast_budget(fixed) == 50 << 20
        spark.conf.set(key, "-1")
        assert joins.broadcast_budget(fixed) == 0 and not joins.fits_broadcast(fixed, 3)
        assert joins.bounded_broadcast(fixed, 3) is not fixed  # asked for by name
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)

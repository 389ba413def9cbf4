from tripspark.operators import aggregates
from tripspark.plans import trip_queries as Q
from tripspark.plans.explain import explain_text

from helpers import trip, trips_df, vendors_df


def test_avg_duration_by_hour_variants(spark):
    df = trips_df(spark, [
        trip(1, "2015-03-10 05:00:00", "2015-03-10 05:10:00"),   # 600 s
        trip(2, "2015-03-10 05:30:00", "2015-03-10 05:50:00"),   # 1200 s
        trip(3, "2015-03-10 05:40:00", "2015-03-10 05:40:00"),   # 0 s
        trip(4, "2015-03-10 06:00:00", "2015-03-10 05:00:00"),   # -3600 s
    ])
    df_rows = [tuple(r) for r in Q.avg_trip_duration_per_hour(df).collect()]
    assert df_rows == [("05", 0.9)]
    rdd_rows = [tuple(r) for r in Q.avg_trip_duration_per_hour(df, variant="rdd").collect()]
    assert rdd_rows == [("05", 0.6), ("06", -3.6)]
    minutes = Q.avg_trip_duration_per_hour(df, scale=60.0).collect()
    assert minutes[0].AverageTripDuration == 15.0


def test_max_cost_by_vendor_join_semantics(spark):
    t = trips_df(spark, [
        trip(1, "2015-03-10 05:00:00", "2015-03-10 05:10:00", cost=5.0),
        trip(2, "2015-03-10 05:00:00", "2015-03-10 05:10:00", cost=50.0),   # two vendors
        trip(3, "2015-03-10 05:00:00", "2015-03-10 05:10:00", cost=500.0),  # no vendor
        trip(4, "2015-03-10 05:00:00", "2015-03-10 05:10:00", cost=7.0),
    ])
    v = vendors_df(spark, [(1, 2), (2, 2), (2, 10), (4, 10)])
    rows = [tuple(r) for r in Q.max_trip_cost_per_vendor(t, v).collect()]
    assert rows == [(2, 50.0), (10, 50.0)]                  # numeric order
    rdd = [tuple(r) for r in Q.max_trip_cost_per_vendor(t, v, variant="rdd").collect()]
    assert rdd == [("10", 50.0), ("2", 50.0)]               # text order


def test_preaggregation_is_exact_with_hot_key(spark):
    # one trip id holds a third of all fact rows, and appears twice in vendors
    rows = [trip(7, "2015-03-10 05:00:00", "2015-03-10 05:10:00", cost=float(i)) for i in range(300)]
    rows += [trip(i, "2015-03-10 05:00:00", "2015-03-10 05:10:00", cost=float(i % 97)) for i in range(1000, 1600)]
    t = trips_df(spark, rows)
    v = vendors_df(spark, [(7, 1), (7, 2)] + [(i, 1 + i % 3) for i in range(1000, 1600)])
    fast = aggregates.max_cost_by_vendor(t, v).collect()
    plain = aggregates.max_cost_by_vendor(t, v, preaggregate=False).collect()
    assert fast == plain
    assert dict((r.VendorId, r.MaxTripCost) for r in fast) == {1: 299.0, 2: 299.0, 3: 96.0}


def test_partial_aggregation_in_plan(spark):
    from conftest import SF_SMALL
    from tripspark.sources import trips

    plan = explain_text(Q.avg_trip_duration_per_hour(trips(spark, SF_SMALL)))
    # partial + final hash aggregate around one hash exchange
    assert plan.count("HashAggregate") >= 2 and "Arguments: hashpartitioning(" in plan
    assert "ReadSchema: struct<startDate:timestamp_ntz,endDate:timestamp_ntz>" in plan


def test_hot_dimension_key_gives_the_same_maxima(spark):
    # trip 7 holds a third of all vendor rows, with many distinct vendors
    t = trips_df(spark, [trip(i, "2015-03-10 05:00:00", "2015-03-10 05:10:00", cost=float(i % 50))
                         for i in range(1, 2001)])
    v = vendors_df(spark, [(7, 100 + (j % 40)) for j in range(1000)] + [(i, 1 + i % 3) for i in range(1, 2001)])
    plain = aggregates.max_cost_by_vendor(t, v)
    assert plain.collect() == aggregates.max_cost_by_vendor(t, v, preaggregate=True).collect()
    assert plain.count() == 43


def test_adaptive_execution_splits_a_hot_vendor_key(spark):
    from pyspark.sql import functions as F

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, x in settings.items():
            spark.conf.set(k, x)
        t = spark.range(0, 200_000).repartition(8).select(F.col("id"), (F.col("id") % 1000).cast("double").alias("cost"))
        v = spark.range(0, 300_000).repartition(8).select(
            F.when(F.col("id") < 200_000, F.lit(42)).otherwise(F.col("id") % 200_000).alias("id"), (F.col("id") % 5).cast("int").alias("vendor"))
        out = aggregates.max_cost_by_vendor(t, v)
        rows = out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString() and len(rows) == 5
    finally:
        for k, x in before.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)

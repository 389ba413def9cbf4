import math
import random

import pytest
from pyspark.sql import functions as F

from tripspark.operators import topk
from tripspark.plans.explain import explain_text


def brute_force(facts, dims, k):
    joined = [(fid, s, x, v) for (fid, s, x) in facts for (did, v) in dims if did == fid]

    def sort_key(r):
        s = r[1]
        # speed desc, NULL last, NaN first; then id, vendor ascending
        return (s is None, 0 if s is not None and math.isnan(s) else 1, -(s or 0.0) if s is not None and not math.isnan(s) else 0, r[0], r[3], r[2])

    return sorted(joined, key=sort_key)[:k]


def run(spark, facts, dims, k, **kw):
    f = spark.createDataFrame(facts, "id long, speed double, x double")
    d = spark.createDataFrame(dims, "id long, vendor int")
    out = topk.top_k_join(f, d, key="id", score="speed", k=k, fact_cols=["x"], dim_cols=["vendor"], **kw)
    return [(r.id, r.speed, r.x, r.vendor) for r in out.collect()]


def same(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y):
                continue
            if x != y:
                return False
    return True


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_top_k_join_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    facts = []
    for i in range(400):
        s = rnd.choice([None, math.nan, float(rnd.randint(0, 20)), rnd.random() * 100])
        facts.append((rnd.randint(0, 150), s, float(i)))        # duplicate ids and tied speeds
    dims = [(rnd.randint(0, 200), rnd.randint(1, 4)) for _ in range(300)]
    for k in (1, 5, 37):
        expect = brute_force(facts, dims, k)
        assert same(run(spark, facts, dims, k), expect)
        assert same(run(spark, facts, dims, k, candidates=1), expect)
        assert same(run(spark, facts, dims, k, method="shuffle"), expect)


def test_top_k_join_sparse_matches_needs_expansion(spark):
    # only the slowest trips have a vendor: no candidate matches, and the shuffled form takes over
    facts = [(i, float(1000 - i), float(i)) for i in range(1000)]
    dims = [(i, 1) for i in range(990, 1000)]
    assert same(run(spark, facts, dims, 5), brute_force(facts, dims, 5))


def test_top_k_join_hot_dimension_key(spark):
    facts = [(i, float(i), 0.0) for i in range(50)]
    dims = [(49, v % 7) for v in range(3000)] + [(i, 1) for i in range(49)]
    assert same(run(spark, facts, dims, 10), brute_force(facts, dims, 10))


def test_top_k_plans_take_ordered(spark):
    df = spark.range(100).withColumn("s", F.col("id") * 2)
    plan = explain_text(topk.top_k(df, [F.col("s").desc()], 5))
    assert "TakeOrderedAndProject" in plan


def test_fallback_does_not_emit_all_pairs_of_a_hot_key(spark):
    # trip 5 is duplicated 2000 times and has 2000 vendor rows: 4M pairs in a plain join
    facts = [(5, 50.0, 1.0)] * 2000 + [(i, float(i), 0.0) for i in range(100)]
    dims = [(5, v % 9) for v in range(2000)] + [(i, 1) for i in range(100)]
    f = spark.createDataFrame(facts, "id long, speed double, x double")
    d = spark.createDataFrame(dims, "id long, vendor int")
    out = topk.top_k_join(f, d, key="id", score="speed", k=7, fact_cols=["x"], dim_cols=["vendor"],
                          method="shuffle")
    got = [(r.id, r.speed, r.x, r.vendor) for r in out.collect()]
    assert got == [(99, 99.0, 0.0, 1), (98, 98.0, 0.0, 1), (97, 97.0, 0.0, 1), (96, 96.0, 0.0, 1),
                   (95, 95.0, 0.0, 1), (94, 94.0, 0.0, 1), (93, 93.0, 0.0, 1)]
    hot = topk.top_k_join(f.where("id = 5"), d, key="id", score="speed", k=7, fact_cols=["x"],
                          dim_cols=["vendor"], method="shuffle")
    assert [r.vendor for r in hot.collect()] == [0] * 7
    plan = explain_text(topk._per_key_limited_join(f, d, "id", "speed", ["vendor"], ["x"], 7))
    assert "WindowGroupLimit" in plan


def test_variable_width_candidates_use_the_shuffled_form(spark):
    facts = [(i, float(i % 13), "t" * (i % 5)) for i in range(200)]
    dims = [(i, 1 + i % 3) for i in range(0, 200, 2)]
    f = spark.createDataFrame(facts, "id long, speed double, x string")
    d = spark.createDataFrame(dims, "id long, vendor int")
    out = topk.top_k_join(f, d, key="id", score="speed", k=9, fact_cols=["x"], dim_cols=["vendor"])
    plan = explain_text(out)
    assert "WindowGroupLimit" in plan          # not the candidate path
    got = [(r.id, r.speed, r.x, r.vendor) for r in out.collect()]
    assert same(got, brute_force(facts, dims, 9))


def test_k_is_validated(spark):
    df = spark.range(10).withColumn("s", F.col("id") * 1.0)
    for bad in (0, -1):
        with pytest.raises(ValueError):
            topk.top_k(df, [F.col("s").desc()], bad)
        with pytest.raises(ValueError):
            topk.top_k_join(df, df.select("id"), key="id", score="s", k=bad, fact_cols=[], dim_cols=[])


def test_unmatched_candidates_cost_one_more_pass(spark, tmp_path, monkeypatch):
    """Facts and dimension are planned once as candidates and once shuffled, however few match."""
    f = spark.createDataFrame([(i, float(5000 - i), 0.0) for i in range(5000)], "id long, speed double, x double")
    d = spark.createDataFrame([(i, 1) for i in range(4990, 5000)], "id long, vendor int")
    calls = []
    plain = topk._per_key_limited_join
    monkeypatch.setattr(topk, "_per_key_limited_join", lambda *a: calls.append(1) or plain(*a))
    before = type(f).checkpoint
    monkeypatch.setattr(type(f), "checkpoint", lambda self, *a, **k: calls.append(2) or before(self, *a, **k))
    out = topk.top_k_join(f, d, key="id", score="speed", k=5, fact_cols=["x"], dim_cols=["vendor"])
    assert [r["id"] for r in out.collect()] == [4990, 4991, 4992, 4993, 4994]
    assert calls == [2, 2, 1]

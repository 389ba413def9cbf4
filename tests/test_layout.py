"""File layouts, safe replacement, early limits and reductions: results, file sizes and what scans read."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlog import run_logged
from tripspark.operators import joins
from tripspark.operators.aggregates import max_by_dimension
from tripspark.operators.topk import top_k_join
from tripspark.plans.explain import explain_text
from tripspark.sinks import compact, convert_csv, folder_size, replace_result, write_lookup_table, write_pair_lines

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("v", T.DoubleType())])


def rows(spark, n, start=0):
    k = F.col("id") + start
    return spark.range(n).select(k.alias("id"), F.md5(k.cast("string")).alias("name"), (k * 0.5).alias("v"))


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_lookup_reads_few_row_groups_of_many_files(tmp_path):
    """60 files of 2,000 rows, dealt without order: the plain copy is read whole, the others nearly not."""
    parts = run_logged(f"""
from tripspark.operators.filters import point_lookup
from tripspark.sinks import write_lookup_table, write_result
df = spark.range(120000).select(((F.col("id") * 7919) % 120000).alias("id"), F.md5(F.col("id").cast("string")).alias("name")).repartition(60)
base = {str(tmp_path)!r}
write_result(df, base + "/plain")
write_lookup_table(df, base + "/range", "id", files=60)
write_lookup_table(df, base + "/bloom", "id", layout="bloom", files=60, keys_per_row_group=2000)
want = None
for name in ("plain", "range", "bloom"):
    table = spark.read.schema(df.schema).parquet(base + "/" + name)
    assert len(table.inputFiles()) == 60, (name, len(table.inputFiles()))
    spark.sparkContext.setJobDescription(name)
    got = point_lookup(table, "id", 4242).collect()
    spark.sparkContext.setJobDescription("")
    want = want or got
    assert got == want and len(got) == 1
""", str(tmp_path))
    assert parts["plain"]["rows_read"] > 60_000  # minima and maxima exclude next to nothing
    assert parts["range"]["rows_read"] <= 3 * 2_000
    assert parts["bloom"]["rows_read"] <= 4 * 2_000


def test_range_layout_splits_a_hot_key(spark, tmp_path):
    hot = rows(spark, 4000).withColumn("id", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")))
    path = write_lookup_table(hot, str(tmp_path / "t"), "id", files=20)
    sizes = folder_size(spark, path)
    assert sizes.files == 20 and sizes.largest <= 2 * sizes.bytes / sizes.files
    assert bag(spark.read.parquet(path)) == bag(hot)
    with pytest.raises(ValueError):
        write_lookup_table(hot, path, "id", layout="hash")
    with pytest.raises(ValueError):
        write_lookup_table(hot, path, "id")


@pytest.mark.parametrize("files,kind", [(1, "one huge file"), (300, "tiny files")])
@pytest.mark.parametrize("cluster", [None, "id"])
def test_conversion_makes_even_files(spark, tmp_path, files, kind, cluster):
    source = rows(spark, 60_000)
    csv = str(tmp_path / "csv")
    source.repartition(files).write.csv(csv)
    target = 200_000
    table = convert_csv(spark, csv, str(tmp_path / "pq"), SCHEMA, target_file_bytes=target, cluster_by=cluster)
    sizes = folder_size(spark, str(tmp_path / "pq"))
    assert sizes.files > 4 and sizes.largest <= 2 * target and sizes.smallest >= target / 2, (kind, sizes)
    assert bag(table) == bag(source)


def test_conversion_of_skewed_and_compressed_input(spark, tmp_path):
    """One large and many tiny gzip files: text bytes are a poor guess, the written files are put right."""
    source = rows(spark, 50_000)
    csv = str(tmp_path / "csv")
    source.where("id < 48000").coalesce(1).write.option("compression", "gzip").csv(csv)
    source.where("id >= 48000").repartition(40).write.mode("append").option("compression", "gzip").csv(csv)
    target = 150_000
    table = convert_csv(spark, csv, str(tmp_path / "pq"), SCHEMA, target_file_bytes=target)
    sizes = folder_size(spark, str(tmp_path / "pq"))
    assert sizes.largest <= 2 * target and sizes.smallest >= target / 2, sizes
    assert bag(table) == bag(source)


def test_conversion_of_nothing(spark, tmp_path):
    csv = str(tmp_path / "csv")
    rows(spark, 0).write.csv(csv)
    assert convert_csv(spark, csv, str(tmp_path / "pq"), SCHEMA).count() == 0


def test_compaction_leaves_good_folders_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, 20_000).repartition(30).write.parquet(path)
    total = folder_size(spark, path).bytes
    assert compact(spark, path, target_file_bytes=total // 3)
    assert folder_size(spark, path).files in (2, 3, 4)
    assert not compact(spark, path, target_file_bytes=total // 3)
    assert spark.read.parquet(path).count() == 20_000


# --- replacing a result -------------------------------------------------------------------

def test_a_failing_write_leaves_the_former_result(spark, tmp_path):
    path = str(tmp_path / "out")
    replace_result(rows(spark, 10), path)
    bad = rows(spark, 1000).repartition(8).withColumn("v", F.when(F.col("id") == 777, F.raise_error(F.lit("half-way")).cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="half-way"):
        replace_result(bad, path)
    assert bag(spark.read.parquet(path)) == bag(rows(spark, 10))
    assert os.listdir(tmp_path) == ["out"]
    text = str(tmp_path / "text")
    write_pair_lines(rows(spark, 3), "id", "v", text, keep_former=True)
    with pytest.raises(Exception, match="half-way"):
        write_pair_lines(bad, "id", "v", text, keep_former=True)
    assert spark.read.text(text).count() == 3


def test_a_result_may_be_made_from_the_one_it_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    replace_result(rows(spark, 10), path)
    replace_result(spark.read.parquet(path).where("id < 4"), path, single_file=True)
    assert bag(spark.read.parquet(path)) == bag(rows(spark, 4))
    assert sorted(os.listdir(tmp_path)) == ["out"]


# --- limits and reductions -------------------------------------------------------------------

def test_any_rows_stops_early(tmp_path):
    parts = run_logged(f"""
from tripspark.operators import joins
path = {str(tmp_path)!r} + "/dim"
spark.range(200000).repartition(100).write.parquet(path)
dim = spark.read.parquet(path)
spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
spark.sparkContext.setJobDescription("any")
some = joins.any_rows(dim, 100)
assert some.count() == 100 and some.join(dim, "id").count() == 100 and some.schema == dim.schema
spark.sparkContext.setJobDescription("any only")
joins.any_rows(dim, 100)
spark.sparkContext.setJobDescription("ordered")
joins.limited_dimension(dim, "id", 100).collect()
""", str(tmp_path))
    assert parts["any only"]["rows_read"] <= 10_000 and parts["any only"]["tasks"] <= 2
    assert parts["ordered"]["rows_read"] == 200_000


def _facts_and_dims(spark):
    facts = rows(spark, 3000).where("id % 50 = 7").withColumn("id", F.when(F.col("id") == 57, None).otherwise(F.col("id")))
    dims = spark.range(20_000).select("id", (F.col("id") % 9).alias("kind"))
    return facts, dims


def test_reduction_changes_no_result(spark):
    facts, dims = _facts_and_dims(spark)
    for text in (False, True):
        f = facts.withColumn("id", F.col("id").cast("string")) if text else facts
        small = joins.reduced_by_keys(dims, f, "id", "id")
        assert small.count() < 200
        assert bag(small.join(f, "id")) == bag(dims.join(f, "id"))
    options = dict(fact_key="id", dim_key="id", value="v", attribute="kind", key_alias="k", value_alias="m")
    assert bag(max_by_dimension(facts, dims, reduce_dims=True, **options)) == bag(max_by_dimension(facts, dims, **options))
    top = dict(key="id", score="v", k=7, fact_cols=[], dim_cols=["kind"], method="shuffle")
    assert bag(top_k_join(facts, dims, reduce_dims=True, **top)) == bag(top_k_join(facts, dims, **top))


def test_reduction_is_bounded_and_can_be_off(spark):
    facts, dims = _facts_and_dims(spark)
    plan = explain_text(joins.reduced_by_keys(dims, facts, "id", "id", max_bytes=1 << 20), "extended")
    assert "LeftSemi" in plan and "65536" in plan  # at most 65,536 buckets of 16 bytes
    assert joins.reduced_by_keys(dims, facts, "id", "id", max_bytes=0) is dims
    # fewer buckets than keys: more rows stay, none that matches goes
    crowded = joins.reduced_by_keys(dims, rows(spark, 5000), "id", "id", max_bytes=16 * 1024)
    assert crowded.join(rows(spark, 5000), "id").count() == 5000


def test_reduction_shuffles_fewer_bytes(tmp_path):
    parts = run_logged("""
from tripspark.operators.aggregates import max_by_dimension
spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
from tripspark.operators import joins
stored = {path!r}
spark.range(400000).select("id", (F.col("id") % 1000).alias("day"), (F.col("id") * 1.5).alias("v")).write.parquet(stored)
facts = spark.read.parquet(stored).where("day = 3")  # not a filter on the key: nothing is inferred for the other side
dims = spark.range(400000).select("id", (F.col("id") % 9).alias("kind"))
options = dict(fact_key="id", dim_key="id", value="v", attribute="kind", key_alias="k", value_alias="m")
results = []
for name in ("plain", "reduced"):
    spark.sparkContext.setJobDescription(name)
    d = joins.reduced_by_keys(dims, facts, "id", "id", max_bytes=1 << 20) if name == "reduced" else dims
    results.append(max_by_dimension(facts, d, **options).collect())
assert results[0] == results[1] and len(results[0]) == 9
""".replace("{path!r}", repr(str(tmp_path / "facts"))), str(tmp_path))
    assert parts["reduced"]["shuffle_bytes"] < parts["plain"]["shuffle_bytes"] / 10

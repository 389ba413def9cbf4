"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tripspark.llm import packing, quality_rules, simhash_dedup, tokens
from tripspark.llm.common import crc32_mod
from tripspark.llm.oracle import SQL
from tripspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    frame = QUERIES[name](spark, SF)
    res = con.execute(SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(map(tuple, frame.select(*names).collect())) == sorted(res.fetchall())


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES if k != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]


def test_pipeline_equals_plain_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outputs, now = [], docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, SF).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        outputs.append(now)
        if k < 4:
            assert now.columns == docs.columns
    good, single, clean, mixed = [{r["doc_id"]: r["text"] for r in x.collect()} for x in outputs[:4]]

    # 1: the compiled rules equal the model's own arithmetic
    model = quality_rules.fit(docs, spark.read.parquet(f"{SF}/labels.parquet").where(crc32_mod("doc_id", 4) != 2))
    stats = docs.select("doc_id", quality_rules.statistics("text").alias("s")).collect()
    assert good.keys() == {r["doc_id"] for r in stats if model.score_values(r["s"].asDict()) >= 0.7}
    # 2: one document of each component over all pairs
    prints = {i: np.uint64(simhash_dedup.simhash(t) & (2 ** 64 - 1)) for i, t in good.items()}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and int(np.bitwise_count(prints[i] ^ prints[j])) <= 4 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert single.keys() == {find(i) for i in prints}
    # 3: no document that holds a benchmark item, and all others
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert single.keys() - clean.keys() == {i for i, t in single.items() if any(_holds(words(t), words(x)) for x in items)}
    # 4: copies as the mix counts them
    counts = Counter(r["doc_id"] for r in outputs[3].collect())
    assert set(counts) <= set(clean) and max(counts.values()) <= 3 and all(mixed[i] == clean[i] for i in counts)
    # 5: the rows hold every copy's ids
    segments: dict = {}
    for r in packing.segments(outputs[4]).collect():
        segments.setdefault(r["doc_id"], []).append((r["piece"], bytes(r["ids"])))
    for i, t in mixed.items():
        ids = np.append(tokens.encode(t), tokens.END_ID).astype("<u2")
        pieces = [(p, ids[s:s + 2048].tobytes()) for p, s in enumerate(range(0, len(ids), 2048))]
        assert sorted(segments[i]) == sorted(pieces * counts[i])


def _holds(doc, item):
    shingles = lambda x: [tuple(x[i:i + 5]) for i in range(len(x) - 4)]
    d, w = shingles(doc), Counter(shingles(item))
    n = min(sum(w.values()), len(d))
    if not n or not set(d) & set(w):
        return False
    for at in range(len(d) - n + 1):
        own = Counter(d[at:at + n])
        if sum((own & w).values()) >= 0.8 * sum((own | w).values()):
            return True
    return False

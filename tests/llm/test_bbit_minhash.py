"""b-bit MinHash near-dedup against all pairs."""

from __future__ import annotations

import os
import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripspark.llm import bbit_minhash

from edge import DOCS, docs, rows_of, with_clashes
from eventlog import ROOT, run_logged

NAMES = ("class", "key", "n", "d1", "d2", "sig", "root", "first_id", "known", "shingles", "s", "hash", "component_id", "kept", "n_shingles")


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words)} if len(words) == 1 else {tuple(words[i:i + 2]) for i in range(len(words) - 1)}


def _plain(rows):
    sets = [_set(r[1]) for r in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((r[0], len(sets[i]), least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows)), key=repr)


def _random_docs(seed, n=400):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(2, 120))) for _ in range(25)]
    rows = []
    for i in range(n):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4, 6])):
            words[rng.randrange(len(words))] = f"v{rng.randrange(50)}"
        rows.append((i, " ".join(words), "en", "a", 1))
    return rows


def test_a_worker_keeps_no_words_of_past_texts():
    bbit_minhash.shingle_set("warm up")
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        for k in range(40):
            bbit_minhash.shingle_set(" ".join(f"w{k}x{i}" for i in range(1000)))
        assert tracemalloc.get_traced_memory()[0] - before < 1_000_000
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("slice_rows", [3, 512])
def test_components_equal_all_pairs(spark, slice_rows):
    rows = _random_docs(slice_rows)
    assert rows_of(bbit_minhash.near_duplicates(docs(spark, rows), slice_rows=slice_rows)) == _plain(rows)


def test_links_come_from_contested_buckets_too(spark):
    """One pivot a bucket can't join all: a chain of texts, each similar to the next alone."""
    words = [f"w{i}" for i in range(100)]
    rows, now = [], list(words)
    for i in range(60):
        rows.append((i, " ".join(now), "en", "a", 1))
        for j in range(4):
            now[(i * 4 + j) % 100] = f"x{i}_{j}"
    assert rows_of(bbit_minhash.near_duplicates(docs(spark, rows))) == _plain(rows)


@pytest.mark.parametrize("broadcast_keys", [0, 1 << 20])
def test_only_links_between_components_are_looked_at_again(spark, monkeypatch, broadcast_keys):
    """Links that made the components aren't written and gone through once more in each later step."""
    seen, found = [], bbit_minhash.connected_components

    def components(edges):
        out = found(edges)
        seen.append((edges.collect(), dict(map(tuple, out.collect()))))
        return out

    monkeypatch.setattr(bbit_minhash, "connected_components", components)
    monkeypatch.setattr(bbit_minhash, "BROADCAST_KEYS", broadcast_keys)
    rows = _random_docs(7)
    assert rows_of(bbit_minhash.near_duplicates(docs(spark, rows))) == _plain(rows)
    assert len(seen) > 1 and seen[0][0] and seen[1][0]
    for k, (edges, _) in enumerate(seen):
        for _, roots in seen[:k]:
            assert all(roots.get(x, x) == x for e in edges for x in e)


def test_texts_that_share_a_key_get_their_own_sets(spark):
    """A text with another class's hash and length: the digest tells them apart."""
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(["a b c d e", "a b c d e", "A b c d e", "f g h i j"])]
    table = docs(spark, rows)
    digests = [bbit_minhash._digest(bbit_minhash.shingle_set(r[1])) for r in rows]
    key = spark.createDataFrame([(rows[0][1],)], "text string").select(F.xxhash64("text"), F.length("text")).first()
    classes = spark.createDataFrame(  # both with the first text's key
        [(c, 4, *digests[at], *key, [0] * 10, [c]) for c, at in ((1, 0), (2, 3))],
        "class bigint, n bigint, d1 bigint, d2 bigint, hash bigint, length int, sig array<bigint>, keys array<bigint>")
    link = bbit_minhash._Linker(table, classes, text_col="text", shingle=2, percent=80, slice_rows=8)
    link.prepare(spark.createDataFrame([(1,), (2,)], "class bigint"))
    got = link.sets.collect()
    assert [(r["class"], r["shingles"]) for r in got] == [(1, bbit_minhash.shingle_set(rows[0][1]).view(np.int64).tolist())]


_SHUFFLED = """
sys.path[:0] = {paths!r}
import test_bbit_minhash as t
spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
spark.sparkContext.setCheckpointDir({shared!r})
spark.sparkContext.setJobDescription("op11")
rows = t._random_docs(3, 1200)
assert t.bbit_minhash.near_duplicates(t.docs(spark, rows)).count() == len(rows)
"""


def test_bytes_shuffled_and_tasks(tmp_path, monkeypatch):
    """Sets and signatures are shuffled once for both ends of pairs, sets not where they are made; no step
    has more tasks for what earlier ones stored."""
    monkeypatch.setenv("PYTHONPATH", ROOT)  # for the Python workers
    paths = [os.path.join(ROOT, "tests", "llm"), os.path.join(ROOT, "tests")]
    got = run_logged(_SHUFFLED.format(paths=paths, shared=f"file://{tmp_path}/shared"), str(tmp_path))["op11"]
    assert got["shuffle_bytes"] < 5_300_000 and got["tasks"] < 1_200  # 6,900,882 and 1,486 when all that was done twice


def test_edge_rows(spark):
    table = with_clashes(docs(spark)).withColumns({c: F.lit("x") for c in NAMES if c != "doc_id"})
    got = bbit_minhash.near_duplicates(table)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    expected = [(*r[:3], True if r[0] is None and r[2] is None else r[3]) for r in _plain(DOCS)]
    assert rows_of(got) == sorted(expected, key=repr)
    assert bbit_minhash.near_duplicates(docs(spark, [])).count() == 0


def test_signatures_estimate_similarity(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = np.sort(values[:2500]), np.sort(values[500:])
    sig = [bbit_minhash.packed(bbit_minhash.minima(x)).tolist() for x in (a, b)]
    row = spark.createDataFrame([tuple(sig)], "a array<bigint>, b array<bigint>").select(
        bbit_minhash.equal_slots(F.col("a"), F.col("b")).alias("n"),
        bbit_minhash.equal_slots(F.col("a"), F.col("a")).alias("all"),
        bbit_minhash.similarity_estimate(bbit_minhash.equal_slots(F.col("a"), F.col("b"))).alias("s")).first()
    low = [bbit_minhash._mixed(bbit_minhash.minima(x)) & np.uint64(15) for x in (a, b)]
    assert row["n"] == (low[0] == low[1]).sum() and row["all"] == bbit_minhash.HASHES
    assert abs(row["s"] - 2000 / 3000) < 0.15


def test_similar_sets_share_a_band():
    rng = np.random.default_rng(2)
    for _ in range(50):
        values = rng.integers(0, 1 << 63, 180).astype(np.uint64)
        a, b = values[:160], values[18:178]  # 142 of 178: just below 0.8
        keys = [set(bbit_minhash.band_keys(bbit_minhash.minima(x)).tolist()) for x in (a, b)]
        assert keys[0] & keys[1]

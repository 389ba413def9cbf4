"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Each text gets a 64-bit SimHash over word shingles (vectorised NumPy in a
   pandas UDF; only the 8-byte fingerprint leaves it).
2. Equal fingerprints collapse into one class first, so a group of copies,
   however large, is a single row in everything that follows.
3. The 64 bits are grouped into ``m`` partitions, correlated bits together.
   Thresholds ``t_i >= -1`` with ``sum(t_i + 1) = max_distance + 1`` guarantee
   that any two fingerprints within ``max_distance`` agree within ``t_i`` bits
   on some partition ``i``. The split and the thresholds are those of the
   lowest estimated number of probes and candidates (dynamic programme over
   partitions, estimates from a bounded sample of fingerprints). Estimates
   only steer the cost: every allocation finds every link.
4. Every class probes its variants within ``t_i`` bits and meets the classes
   with that exact partition value; the pair is verified on all 64 bits. A
   pair is reported by its first matching partition only.
5. A partition value that holds more than ``bucket_cap`` classes would emit a
   square of pairs. Its classes (and all that probe it) are linked another,
   also exact way: two fingerprints are within ``d`` bits iff they share a
   midpoint at most ``ceil(d / 2)`` bits from both; every class is listed
   under its midpoints and linked to the smallest class there, which gives the
   same components with rows in proportion to the classes.
6. Connected components over the links; the component id is the smallest
   ``doc_id`` of its documents.

Defined cases: NULL and word-less texts have fingerprint zero and link like any
other; a text of fewer words than a shingle is one shingle; texts are whole, whatever
their length (shingles are hashed in blocks); NULL ids are never
a component id unless the component has no other; components that share an id
or have none stay apart, and one row of each is kept; rows that repeat an id and a text
are listed each by ``near_duplicates``, and one of them is kept by ``keep_one_per_group``; an empty
table gives an empty result; extra columns are ignored or pass through, whatever their names.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import BROADCAST_KEYS, connected_components, nested, row_key, stored, within_flips, without_rows

BITS = 64
#: Lower-cases A-Z only, byte by byte.
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_BLOCK = 1 << 16


def simhash(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text as a signed 64-bit number: a bit is set if it is set
    in more than half of the shingles' XXH64 (seed 42), repeats included."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes.split: ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(line, 42)).view(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, ends = [0, *ends[: len(words) - shingle].tolist()], (ends[shingle - 1:] - 1).tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _BLOCK):
        h = np.array([xxhash.xxh64_intdigest(line[s:e], 42)
                      for s, e in zip(starts[at:at + _BLOCK], ends[at:at + _BLOCK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def simhash_column(text: str | Column, shingle: int = 4) -> Column:
    """SimHash fingerprint (long) of a text column."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return fingerprints(text)


# --- partitions and thresholds ----------------------------------------------------

def bit_groups(sample: np.ndarray, m: int) -> list[list[int]]:
    """Split the 64 bit positions into ``m`` near-equal groups, correlated bits together."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    bits -= bits.mean(axis=0, keepdims=True)
    scale = np.sqrt((bits ** 2).sum(axis=0))
    scale[scale == 0] = 1
    corr = np.abs((bits / scale).T @ (bits / scale))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for k in range(m):
        size = (BITS - sum(map(len, groups))) // (m - k)
        group = [max(left, key=lambda b: (corr[b, left].max(), -b))]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (corr[b, group].sum(), -b)))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def mask_of(bits: list[int]) -> int:
    return int(np.uint64(sum(1 << b for b in bits)).view(np.int64))


def ball(width: int, radius: int) -> int:
    return sum(comb(width, r) for r in range(radius + 1))


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Dynamic programme: thresholds ``t_i >= -1`` with ``sum(t_i + 1) == budget`` of
    least total cost; ``costs[i][t + 1]`` is partition ``i``'s cost at threshold ``t``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for spend in range(min(budget - used, len(own) - 1) + 1):
                new = (cost + own[spend], [*chosen, spend - 1])
                if used + spend not in step or new < step[used + spend]:
                    step[used + spend] = new
        best = step
    return best[budget]


def plan_partitions(sample: np.ndarray, n: int, max_distance: int) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of each probed partition, of least estimated cost for ``n`` fingerprints."""
    best = None
    lone = np.triu_indices(len(sample), 1)
    for m in range(2, max_distance + 2) if max_distance else [1]:
        groups, costs = bit_groups(sample, m), []
        for bits in groups:
            own, part = [0.0], sample & np.uint64(mask_of(bits) & (2 ** 64 - 1))
            apart = np.bitwise_count(part[:, None] ^ part[None, :])[lone]
            for t in range(max_distance + 1):
                chance = max(ball(len(bits), t) / 2.0 ** len(bits), float((apart <= t).mean()) if len(apart) else 0.0)
                probes = ball(len(bits), t)
                own.append(n * probes + n * n / 2 * chance if probes <= 5000 else float("inf"))
            costs.append(own)
        cost, thresholds = allocate(costs, max_distance + 1)
        if best is None or cost < best[0]:
            best = (cost, [(b, t) for b, t in zip(groups, thresholds) if t >= 0])
    return best[1]


# --- links and components -----------------------------------------------------------

def fingerprint_links(classes: DataFrame, max_distance: int = 4, bucket_cap: int = 1024,
                      sample_rows: int = 1000) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (column ``fp``, one row each)
    whose transitive closure is that of all pairs within ``max_distance`` bits."""
    n = classes.count()
    picked = classes.orderBy(F.xxhash64("fp"), "fp").limit(sample_rows).collect()  # bounded by sample_rows
    sample = np.array([r["fp"] for r in picked] or [0], np.int64).view(np.uint64)
    plan = plan_partitions(sample, n, max_distance)

    index, probes = None, None
    for i, (bits, t) in enumerate(plan):
        mask = F.lit(mask_of(bits)).cast("long")
        own = classes.select(F.lit(i).alias("part"), F.col("fp").bitwiseAND(mask).alias("key"), F.col("fp").alias("b"))
        variants = classes.select(F.lit(i).alias("part"), F.explode(
            within_flips(F.col("fp").bitwiseAND(mask), bits, t)).alias("key"), F.col("fp").alias("a"))
        index = own if index is None else index.unionByName(own)
        probes = variants if probes is None else probes.unionByName(variants)

    crowded = stored(index.groupBy("part", "key").count().where(F.col("count") > bucket_cap).select("part", "key"))
    n_crowded = crowded.count()
    through = None
    if n_crowded:
        # At most one per bucket_cap classes and partition; broadcast up to a counted number (12 bytes each).
        few = F.broadcast(crowded) if n_crowded <= BROADCAST_KEYS else crowded
        dense = stored(probes.join(few, ["part", "key"], "left_semi").select(F.col("a").alias("fp")).distinct())
        through = stored(midpoint_links(dense, max_distance))
        index = index.join(few, ["part", "key"], "left_anti")

    apart = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(True)  # no earlier partition reports the pair
    for j, (bits, t) in enumerate(plan):
        earlier = F.bit_count(apart.bitwiseAND(F.lit(mask_of(bits)).cast("long"))) <= F.lit(t)
        first = first & ((F.col("p.part") <= F.lit(j)) | ~earlier)
    if through is not None:  # an earlier partition's crowded value may have been left out
        first = F.lit(True)
    links = (
        probes.alias("p").join(index.alias("i"), (F.col("p.part") == F.col("i.part")) & (F.col("p.key") == F.col("i.key"))
                               & (F.col("a") < F.col("b")) & (F.bit_count(apart) <= F.lit(max_distance)) & first)
        .select("a", "b")
    )
    return links if through is None else links.unionByName(through).distinct()


def midpoint_links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Links with the same closure as all pairs within ``max_distance`` bits, without
    pairing. Two fingerprints are that close iff some value lies within half the
    distance (rounded down) of one and half (rounded up) of the other. Per such value,
    all on its wide list are linked to the smallest on its narrow list; both ends of
    every such link are within ``max_distance`` bits."""
    def listed(radius: int) -> DataFrame:
        return fps.select("fp", F.explode(within_flips(F.col("fp"), list(range(BITS)), radius)).alias("mid"))

    low = listed(max_distance // 2).groupBy("mid").agg(F.min("fp").alias("low"))
    return listed((max_distance + 1) // 2).join(low, "mid").where("low <> fp").select(
        F.col("low").alias("a"), F.col("fp").alias("b")).distinct()


def rooted(fps: DataFrame, max_distance: int = 4, bucket_cap: int = 1024) -> DataFrame:
    """``fps`` (a stored table with ``fp``) plus ``root``, the smallest fingerprint of the component. Only linked
    fingerprints are joined; up to a counted number (16 bytes each) they are broadcast."""
    classes = stored(fps.select("fp").distinct())
    roots = connected_components(fingerprint_links(classes, max_distance, bucket_cap))
    linked = roots.select(F.col("node").alias("fp"), "root")
    linked = F.broadcast(linked) if linked.count() <= BROADCAST_KEYS else linked
    return fps.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_distance: int = 4, bucket_cap: int = 1024) -> DataFrame:
    """``doc_id, fingerprint`` (16 lower-case hex digits), ``component_id``: one row per row of ``docs``."""
    fps = stored(docs.select(F.col(id_col).alias("doc_id"), simhash_column(F.col(text_col), shingle).alias("fp")))
    rows = rooted(fps, max_distance, bucket_cap)
    ids = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(ids, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_distance: int = 4, bucket_cap: int = 1024) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: one whose id is the
    component id (of rows that share that id or have none, one). Columns as given.

    Fingerprints are computed once and stored with the rows' keys; the documents are
    then read again and lose the rows whose keys go."""
    keys = ["key_id", "key_hash", "key_length"]
    fps = stored(docs.select(*row_key(id_col, text_col), simhash_column(F.col(text_col), shingle).alias("fp")))
    # Components are told apart by root: those of NULL ids, or of an id repeated with other texts, share a component id.
    rows = rooted(fps, max_distance, bucket_cap).select("root", *keys)
    # The row that stays: of the smallest id (NULL last), and of several texts under it the one of the least key.
    stays = F.min(F.struct(F.col("key_id").isNull().alias("none"), *keys)).alias("stays")
    groups = stored(rows.groupBy("root").agg(F.count(F.lit(1)).alias("n"), stays).where("n > 1"))
    small = groups.count() <= BROADCAST_KEYS
    same = [F.col(k).eqNullSafe(F.col(f"stays.{k}")) for k in keys]
    judged = rows.join(F.broadcast(groups) if small else groups, "root").withColumn("stay", same[0] & same[1] & same[2])
    counted = stored(judged.groupBy(*keys).agg(F.max("stay").alias("stay"), F.count(F.lit(1)).alias("rows")))
    again = counted.where("stay and rows > 1").select(*keys)  # the row that stays, given several times
    if again.isEmpty():
        return without_rows(docs, counted.where("not stay").select(*keys), id_col=id_col, text_col=text_col)
    rest = without_rows(docs, counted.where("not stay or rows > 1").select(*keys), id_col=id_col, text_col=text_col)
    repeated = without_rows(docs, again, id_col=id_col, text_col=text_col, keep=True)
    once = repeated.select(nested(repeated), *row_key(id_col, text_col)).dropDuplicates(keys)
    return rest.unionByName(once.select("row.*"))

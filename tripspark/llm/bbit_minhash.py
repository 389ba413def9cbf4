"""Near-duplicates by b-bit MinHash: exact Jaccard links among candidates of banded minima.

1. A document's distinct shingles are hashed; :data:`BANDS` x :data:`ROWS` multiplicative
   hash functions give its minima. Each band's minima make one band key; of every
   minimum only ``b`` mixed bits are kept, packed into longs (the signature).
2. Equal sets (size and 128-bit digest) collapse into one class, so a group of copies,
   however large, is one row in all that follows.
3. Classes that share a band key are candidates. No bucket is paired out: each class
   meets its buckets' pivots, the most central classes (those that share most
   buckets with others, as an original does with its variants). A pair goes on if the
   similarity that its signatures estimate, from the count of equal slots less the
   chance collisions ``2 ** -b``, is not below the threshold by over six standard
   deviations. What goes on is confirmed on the full sets: first each class's
   best pair, then those that would still join two components.
4. Buckets that then hold several components are contested. The classes in them meet once
   more, now by their rarest shingles: of two similar sets the rarest fifths must
   overlap, and the shingles rarer than the first common one bound what can be in
   common. (In a family of variants the rare ones are the variants' own, so hardly a
   pair below the threshold gets through.) Common shingles are cut into slices over many
   tasks. Signatures and sets judge the rest. So no pair is left out.
5. Connected components; the component id is the smallest ``doc_id``.

A pair at the threshold of 0.8 shares no band with probability (1 - 0.8 ** 5) ** 32 =
3e-6, one at 0.85 with 2e-8; such a link counts only if nothing else connects its ends.

Defined cases: a text of fewer words than a shingle is one shingle; NULL and word-less
texts have no set and are linked with nothing; rows that repeat an id or a text are rows of
their own; NULL ids are a component id only where a component has no other (and
then kept); texts are whole, whatever their length; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import floor, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import BROADCAST_KEYS, connected_components, stored, text_or_empty

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Bits kept of a minimum.
BITS = 4
_SLOTS = 64 // BITS
#: Lower-cases A-Z only, byte by byte.
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_DRAWS = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 64, (3, HASHES), np.uint64)
_FACTORS, _SHIFTS, _BAND_FACTORS = _DRAWS[0] | np.uint64(1), _DRAWS[1], (_DRAWS[2] | np.uint64(1)).reshape(BANDS, ROWS)
_AT_ONCE = 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, shingle: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes.split: ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    known = {w: xxhash.xxh64_intdigest(w, 7) for w in set(words)}  # of this text only: a worker outlives its tasks
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that isn't empty."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _AT_ONCE):
        some = shingles[None, at:at + _AT_ONCE] * _FACTORS[:, None] + _SHIFTS[:, None]
        np.minimum(low, some.min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One key per band, from its minima and its number."""
    rows = _mixed(low.reshape(BANDS, ROWS)) * _BAND_FACTORS
    return _mixed(rows.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    """``BITS`` mixed bits of each minimum, packed into longs."""
    bits = (_mixed(low) & np.uint64((1 << BITS) - 1)).reshape(-1, _SLOTS)
    return np.bitwise_or.reduce(bits << (np.arange(_SLOTS, dtype=np.uint64) * np.uint64(BITS)), axis=1).view(np.int64)


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_intdigest(shingles.tobytes(), len(shingles))
    return tuple(np.array([raw >> 64, raw & (1 << 64) - 1], np.uint64).view(np.int64).tolist())


def _sketches(shingle: int):
    kind = pa.struct([("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("sig", pa.list_(pa.int64())),
                      ("keys", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<n: bigint, d1: bigint, d2: bigint, sig: array<bigint>, keys: array<bigint>>")
    def sketches(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            s = shingle_set(text.as_py(), shingle)
            if not len(s):
                out.append({"n": 0, "d1": 0, "d2": 0, "sig": [], "keys": []})
                continue
            d1, d2 = _digest(s)
            low = minima(s)
            out.append({"n": len(s), "d1": d1, "d2": d2, "sig": packed(low), "keys": band_keys(low)})
        return pa.array(out, kind)

    return sketches


def _sets(shingle: int):
    @F.arrow_udf("struct<d1: bigint, d2: bigint, shingles: array<bigint>>")
    def sets(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            s = shingle_set(text.as_py(), shingle)
            d1, d2 = _digest(s)
            out.append({"d1": d1, "d2": d2, "shingles": s.view(np.int64)})
        return pa.array(out, pa.struct([("d1", pa.int64()), ("d2", pa.int64()), ("shingles", pa.list_(pa.int64()))]))

    # Not pushed below the join that picks the texts, as the optimiser would a filter on its result.
    return sets.asNondeterministic()


def equal_slots(a: Column, b: Column) -> Column:
    """Number of equal slots of two packed signatures, by bit counts."""
    ones = sum(1 << (BITS * i) for i in range(_SLOTS))
    mask = F.lit(ones - (1 << 64) if ones >> 63 else ones).cast("long")

    def unequal(i: int) -> Column:
        x = F.element_at(a, i + 1).bitwiseXOR(F.element_at(b, i + 1))
        step = BITS // 2
        while step:  # folds each slot's bits into its lowest
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
            step //= 2
        return F.bit_count(x.bitwiseAND(mask))

    return F.lit(HASHES) - reduce(Column.__add__, [unequal(i) for i in range(HASHES // _SLOTS)])


def least_slots(threshold: float, deviations: float = 6.0) -> int:
    """Fewer equal slots than these are that many standard deviations below what ``threshold`` gives."""
    chance = 2.0 ** -BITS
    p = chance + (1 - chance) * threshold
    return max(0, floor(HASHES * p - deviations * sqrt(HASHES * p * (1 - p))))


def similarity_estimate(slots: Column) -> Column:
    """Jaccard similarity from the number of equal slots, corrected for chance collisions."""
    chance = 2.0 ** -BITS
    return F.greatest(F.lit(0.0), (slots / F.lit(float(HASHES)) - F.lit(chance)) / F.lit(1 - chance))


def _sizes_allow(n: Column, m: Column, percent: int) -> Column:
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


class _Linker:
    """Candidates and confirmed links among classes (``class, n, d1, d2, sig, keys, hash, length``)."""

    def __init__(self, docs: DataFrame, classes: DataFrame, *, text_col: str, shingle: int, percent: int,
                 slice_rows: int) -> None:
        self.docs, self.classes, self.text_col = docs, classes, text_col
        self.shingle, self.percent, self.slice_rows = shingle, percent, slice_rows
        rows = classes.select("class", F.explode("keys").alias("key"))
        shared = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
        # Whether some numbers for each class, or for each key of several, are broadcast: both are counted.
        self.few, self.few_keys = classes.count() <= BROADCAST_KEYS, shared.count() <= BROADCAST_KEYS
        rows = rows.join(self.of_keys(shared), "key")
        # Central classes meet many others: an original more than its variants.
        central = rows.groupBy("class").agg(F.sum("m").alias("score"))
        self.buckets = stored(rows.select("key", "class").join(self.of_classes(central), "class").select("key", "class", "score"))
        self.sets: DataFrame | None = None

    def of_classes(self, rows: DataFrame) -> DataFrame:
        """``rows`` (some numbers a class), broadcast up to a counted number of classes, else joins on them are shuffled."""
        return F.broadcast(rows) if self.few else rows

    def of_keys(self, rows: DataFrame) -> DataFrame:
        """``rows`` (a number or two a shared band key), broadcast up to a counted number of such keys."""
        return F.broadcast(rows) if self.few_keys else rows

    @staticmethod
    def with_ends(pairs: DataFrame, rows: DataFrame) -> DataFrame:
        """``pairs`` with the ``rows`` of both ends, as ``<name>1`` and ``<name>2``: both sides are the same
        projection up to names, so that the rows are shuffled once for the two joins."""
        one, two = (rows.select(*[F.col(c).alias(f"{c}{i}") for c in rows.columns]) for i in (1, 2))
        return pairs.join(one, F.col("class") == F.col("class1")).join(two, F.col("pivot") == F.col("class2"))

    def judged(self, pairs: DataFrame) -> DataFrame:
        """``(class, pivot, slots)`` of the distinct pairs whose signatures allow a link; ``class < pivot``."""
        pairs = pairs.where("class <> pivot").select(
            F.least("class", "pivot").alias("class"), F.greatest("class", "pivot").alias("pivot")).distinct()
        both = self.with_ends(pairs, self.classes.select("class", "n", "sig"))
        slots = equal_slots(F.col("sig1"), F.col("sig2"))
        allowed = _sizes_allow(F.col("n1"), F.col("n2"), self.percent) & (slots >= least_slots(self.percent / 100))
        return stored(both.where(allowed).select("class", "pivot", slots.alias("slots")))

    def pivots(self) -> DataFrame:
        """Every class with the most central one of each of its buckets."""
        pivot = F.max_by("class", F.struct("score", "class")).alias("pivot")
        return self.judged(self.buckets.join(self.of_keys(self.buckets.groupBy("key").agg(pivot)), "key").select("class", "pivot"))

    def contested(self, rows: DataFrame, roots: DataFrame) -> DataFrame:
        """``rows`` (``key, class`` and more) of the keys whose classes lie in several components, with ``root, main`` (in the
        key's largest component?), ``others`` (rows outside it) and ``members``."""
        rows = rows.join(self.of_classes(roots), "class")
        parts = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
        mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max_by("root", F.struct("c", "root")).alias("top"),
                                         F.sum("c").alias("members"), F.max("c").alias("most")).where("parts > 1")
        return rows.join(mixed, "key").withColumns({"main": F.col("root") == F.col("top"), "others": F.col("members") - F.col("most")}).drop(
            "parts", "top", "most")

    def rare_shingles(self, classes: DataFrame) -> DataFrame:
        """``(key, class, n, left)``: each class's rarest shingles among ``classes``, as many as it can't have
        without sharing one of them with a similar one; ``left`` counts the shingles from this one on."""
        self.prepare(classes)
        known = classes.join(self.sets, "class").select("class", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
        # What one class alone has comes first in its order; only the others are listed, ranked from there on.
        common = known.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        own = Window.partitionBy("class")  # one row per shingle of a class
        rank = F.row_number().over(own.orderBy("c", "key"))
        ranked = known.join(common, "key").withColumn("left", F.count(F.lit(1)).over(own) - rank + 1)
        return ranked.where(100 * F.col("left") >= F.lit(self.percent) * F.col("n")).select("key", "class", "n", "left")

    def exhausted(self, roots: DataFrame) -> DataFrame:
        """``(class, pivot, slots)`` of all pairs of contested classes from different components that may be similar enough.

        In one order of all shingles, rarest first, similar sets share one of their first; from the first one that they
        share they can have no more in common than what either has left. One class of such a pair lies
        outside the shingle's largest component: those meet all that have the shingle, in slices."""
        rows = self.buckets.join(self.of_classes(roots), "class")
        mixed = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
        asked = stored(rows.join(self.of_keys(mixed), "key", "left_semi").select("class").distinct())
        inside = stored(self.contested(self.rare_shingles(asked), roots))
        own, all_ = (F.ceil(F.col(c) / F.lit(self.slice_rows)) for c in ("others", "members"))

        def each(n: Column) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

        left = inside.where("not main").select("key", "class", "root", "n", "left", F.pmod(F.xxhash64("class"), own).alias("i"),
                                               each(all_).alias("j"))
        right = inside.select("key", F.col("class").alias("pivot"), F.col("root").alias("root2"), F.col("n").alias("m"),
                              F.col("left").alias("left2"), F.pmod(F.xxhash64("class"), all_).alias("j"), each(own).alias("i"))
        common = F.least("left", "left2")
        close = 100 * common >= F.lit(self.percent) * (F.col("n") + F.col("m") - common)
        met = left.join(right, ["key", "i", "j"]).where((F.col("root") != F.col("root2")) & close)
        return self.judged(met.select("class", "pivot"))

    def prepare(self, asked: DataFrame) -> None:
        """Make the full sets of the classes ``asked`` for (each once) that aren't known yet."""
        if self.sets is not None:
            asked = asked.join(self.of_classes(self.sets.select("class")), "class", "left_anti")
        asked = stored(self.classes.select("class", "d1", "d2", "hash", "length").join(self.of_classes(asked), "class"))
        n = asked.count()
        if self.sets is not None and not n:
            return
        asked = F.broadcast(asked) if n <= BROADCAST_KEYS else asked
        keyed = self.docs.select(text_or_empty(self.text_col).alias("text")).withColumns(
            {"hash": F.xxhash64("text"), "length": F.length("text")})
        # The texts of these classes, once each; should two texts share a key, the set's digest tells. What is
        # dealt by class are these texts: their sets stay where they are made.
        texts = keyed.join(asked, ["hash", "length"]).groupBy("class").agg(
            F.first("d1").alias("d1"), F.first("d2").alias("d2"), F.collect_set("text").alias("texts"))
        made = texts.select("class", "d1", "d2", F.explode("texts").alias("text")).select(
            "class", "d1", "d2", _sets(self.shingle)("text").alias("s")).where("s.d1 = d1 AND s.d2 = d2")
        found = stored(made.groupBy("class").agg(F.first("s.shingles").alias("shingles")))
        self.sets = found if self.sets is None else self.sets.unionByName(found)

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The ``pairs`` whose full sets are similar enough."""
        common = F.size(F.array_intersect("shingles1", "shingles2"))
        union = F.size("shingles1") + F.size("shingles2") - common
        return self.with_ends(pairs, self.sets).where(F.lit(100) * common >= F.lit(self.percent) * union).select(*pairs.columns)

    def apart(self, pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
        """``(class, pivot, a, b)``: the ``pairs`` whose ends lie in different components, and these components' roots."""
        if roots is None:  # each class is a component
            return pairs.select("class", "pivot", F.col("class").alias("a"), F.col("pivot").alias("b"))
        one, two = (self.of_classes(roots).select(F.col("class").alias(c), F.col("root").alias(r)) for c, r in (("class", "a"), ("pivot", "b")))
        return pairs.select("class", "pivot").join(one, "class").join(two, "pivot").where("a <> b").select("class", "pivot", "a", "b")

    def merged(self, links: DataFrame, roots: DataFrame | None) -> DataFrame:
        """``(class, root)`` of every class after ``links`` between the components ``(a, b)`` of ``roots``: only these
        links are looked at, not those that made the components."""
        found = connected_components(links.select("a", "b")).select(F.col("node").alias("root"), F.col("root").alias("top"))
        before = self.classes.select("class", F.col("class").alias("root")) if roots is None else roots
        return stored(before.join(self.of_classes(found), "root", "left").select("class", F.coalesce("top", "root").alias("root")))

    def joined(self, roots: DataFrame | None, pairs: DataFrame) -> DataFrame:
        """``roots`` after the confirmed of ``pairs``: first each class's best pair, then those still between components."""
        self.prepare(pairs.select(F.explode(F.array("class", "pivot")).alias("class")).distinct())
        rank = F.max_by(F.struct("class", "pivot"), F.struct("slots", "class", "pivot")).alias("p")
        ends = pairs.select("*", F.posexplode(F.array("class", "pivot")).alias("end", "node"))  # best by either end
        best = stored(ends.groupBy("node", "end").agg(rank).select("p.*").distinct())
        roots = self.merged(self.apart(self.confirmed(best), roots), roots)
        rest = stored(self.apart(pairs, roots).join(best, ["class", "pivot"], "left_anti"))
        return roots if rest.isEmpty() else self.merged(self.confirmed(rest), roots)


def class_roots(docs: DataFrame, classes: DataFrame, *, text_col: str, shingle: int = 2, percent: int = 80,
                slice_rows: int = 4096) -> DataFrame:
    """``(class, root)``: components of the classes' links."""
    link = _Linker(docs, classes, text_col=text_col, shingle=shingle, percent=percent, slice_rows=slice_rows)
    roots = link.joined(None, link.pivots())
    more = link.exhausted(roots)
    return link.of_classes(roots if more.isEmpty() else link.joined(roots, more))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2, percent: int = 80,
                    slice_rows: int = 4096) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``; documents link whose sets of
    distinct shingles have a Jaccard similarity of ``percent`` % or more."""
    text = text_or_empty(text_col)
    sketched = stored(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), F.length(text).alias("length"),
                                  _sketches(shingle)(text).alias("s")))
    rows = sketched.select("doc_id", "hash", "length", "s.n", "s.d1", "s.d2")
    classes = stored(sketched.where("s.n > 0").groupBy("s.n", "s.d1", "s.d2").agg(
        F.min(F.struct("hash", "length")).alias("key"), F.min("doc_id").alias("first_id"), F.first("s.sig").alias("sig"),
        F.first("s.keys").alias("keys")).select(F.monotonically_increasing_id().alias("class"), "n", "d1", "d2", "key.*",
                                                "first_id", "sig", "keys"))
    roots = class_roots(docs, classes, text_col=text_col, shingle=shingle, percent=percent, slice_rows=slice_rows)
    named = stored(classes.select("class", "n", "d1", "d2", "first_id").join(roots, "class"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = named.join(ids, "root").select("n", "d1", "d2", "component_id", F.lit(True).alias("known"))
    joined = rows.join(labelled, ["n", "d1", "d2"], "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END)) AS sh FROM w),
c AS (SELECT md5(array_to_string(sh, chr(10))) AS k, any_value(sh) AS sh, any_value(len(sh)) AS n, min(doc_id) AS first_id FROM s WHERE len(sh) > 0 GROUP BY 1),
u AS (SELECT k, n, unnest(sh) AS x FROM c),
l AS (SELECT a.k AS a, b.k AS b FROM u a JOIN u b ON a.x = b.x AND a.k < b.k AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
g AS (SELECT k AS a, k AS b FROM c UNION SELECT g.a, e.b FROM g JOIN (SELECT a, b FROM l UNION ALL SELECT b, a FROM l) e ON g.b = e.a),
m AS (SELECT g.a AS k, min(c.first_id) AS component FROM g JOIN c ON g.b = c.k GROUP BY g.a),
o AS (SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, CASE WHEN len(s.sh) > 0 THEN m.component ELSE s.doc_id END AS component_id
  FROM s LEFT JOIN m ON len(s.sh) > 0 AND m.k = md5(array_to_string(s.sh, chr(10))))
SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM o
"""

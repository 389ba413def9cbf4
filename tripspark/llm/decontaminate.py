"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming
blocks, exact weighted-shingle check. DataFrame functions only.

Texts are lower-cased and cut into words (runs of letters and digits); shingles
are five consecutive words, weighted by how often they occur in the window.

1. Seeds. A window reaches similarity ``s`` with an item only if it shares at
   least ``s`` times the item's shingles. So only documents with that many
   shingle positions in common with an item can hold such a window, and only
   windows over one of these positions. This bound loses nothing; it spares
   fingerprints of windows that can't match.
2. Every window of the item's number of words over a seed, at every word
   position, gets a 64-bit SimHash of its shingles (bit counts are summed in
   the two 32-bit halves of 32 longs, in an aggregate).
3. Items are listed under the variants of each of five blocks of bits; the
   per-block radii add up so that every fingerprint within ``radius`` bits
   meets its item in at least one block. A window is looked up in the lists of those
   items whose seeds it covers. Candidates within ``radius`` remain.
4. For these, the exact weighted Jaccard similarity of the two shingle bags
   (sum of smaller counts over sum of larger counts) decides, 0.8 or more.

Documents that hold seeds are stored as pieces with the words of at least 4,096 windows
each, and only pieces that a window asks for; each window's words are cut out of its piece.
So past the first cut into words no row grows with the length of a text.

At a similarity of 0.8 the expected distance of two SimHashes is 10 bits; the
default radius of 20 leaves more than three standard deviations.

Defined cases: NULL and empty texts match nothing; items and documents of
fewer than five words have no shingle and match nothing; a document shorter
than the item is one window; repeated items and rows match each by itself, items
without id under a NULL ``item_id``; texts are whole, whatever their length; empty
tables give empty results; extra columns pass through ``drop_contaminated``, whatever their names.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import BROADCAST_KEYS, nested, stored, text_or_empty

SHINGLE = 5
#: Bits of the Hamming blocks (64 together).
BLOCKS = (13, 13, 13, 13, 12)
_LANES = 32
_LANE_ONES = 0x0000000100000001
_HALF = 1 << 30
_KEY = ["_id", "_text_hash"]
#: So many start positions have their words in one row (more, if an item is longer): texts are cut into such pieces.
STRETCH = 4096


def words_of(text: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingle_hashes(words: Column, shingle: int = SHINGLE) -> Column:
    """Array of the hashes of all shingles of a word array (empty if it is too short)."""
    n = F.size(words) - F.lit(shingle - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                     lambda i: F.xxhash64(F.slice(words, i, shingle)))).otherwise(
        F.array().cast("array<bigint>"))


def _lane_sums(h: str) -> list[Column]:
    """32 sums; half ``k`` of sum ``j`` counts the set bits at position ``32 k + j``."""
    return [F.sum(F.shiftrightunsigned(F.col(h), j).bitwiseAND(F.lit(_LANE_ONES))).alias(f"_l{j}") for j in range(_LANES)]


def _fingerprint(count: str) -> Column:
    """The SimHash out of the lane sums: a bit is set if more than half of ``count`` have it.
    The bias lifts exactly those halves to 2**30."""
    bias = (F.lit(_HALF - 1) - F.floor(F.col(count) / 2)).cast("long") * F.lit(_LANE_ONES)
    out = F.lit(0).cast("long")
    for j in range(_LANES):
        top = F.shiftrightunsigned(F.col(f"_l{j}") + bias, 30).bitwiseAND(F.lit(_LANE_ONES))
        out = out.bitwiseOR(F.shiftleft(top, j))
    return out


def simhash_of(rows: DataFrame, key: list[str], hashes: str) -> DataFrame:
    """``key`` plus ``fp``: SimHash of each row's array of hashes (rows of equal key must be equal)."""
    each = rows.select(*key, F.explode(hashes).alias("_h"))
    return each.groupBy(*key).agg(F.count(F.lit(1)).alias("_c"), *_lane_sums("_h")).select(*key, _fingerprint("_c").alias("fp"))


def block_plan(radius: int) -> list[tuple[list[int], int]]:
    """``(bits, radius)`` of each block; the radii plus one add up to ``radius + 1``."""
    out, at, left = [], 0, radius + 1
    for k, width in enumerate(BLOCKS):
        share = ceil(left / (len(BLOCKS) - k))
        left -= share
        if share:
            out.append((list(range(at, at + width)), share - 1))
        at += width
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _within(key: Column, bits: list[int], radius: int) -> Column:
    """Array of all values within ``radius`` flips of ``bits``: one flip, or none, at a time."""
    flips = F.array(*[F.lit(x).cast("long") for x in (0, *[_signed(1 << b) for b in bits])])
    near = F.array(key)
    for _ in range(radius):
        near = F.array_distinct(F.flatten(F.transform(near, lambda k: F.transform(flips, lambda m: k.bitwiseXOR(m)))))
    return near


def _block(fp: Column, bits: list[int]) -> Column:
    return fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))).cast("long"))


def bag(words: Column, start: Column, count: Column, shingle: int = SHINGLE) -> Column:
    """``count`` shingles from word ``start`` (from 0) as strings, each with the number of its
    occurrence, so that set operations on the result compare bags."""
    plain = F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(words, start + i, shingle), " "))
    numbered = F.transform(plain, lambda x, i: F.concat(
        F.size(F.filter(F.slice(plain, 1, i + 1), lambda y: y == x)).cast("string"), F.lit(" "), x))
    once = F.transform(plain, lambda x: F.concat(F.lit("1 "), x))
    return F.when(F.size(F.array_distinct(plain)) == F.size(plain), once).otherwise(numbered)


def contamination(docs: DataFrame, benchmark: DataFrame, *, similarity: float = 0.8, radius: int = 20,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """``_id, _text_hash, item_id, similarity, start_word``: for every document and item with a window
    of ``similarity`` or more, the best window. The first two columns identify the document's row."""
    items = stored(
        benchmark.select(F.col(item_col).alias("item_id"), words_of(item_text_col).alias("item_words"))
        .where(F.size("item_words") >= SHINGLE)
        .groupBy("item_words").agg(F.min("item_id").alias("item_id"), F.collect_set(F.struct("item_id")).alias("item_ids"))  # structs: NULL ids too
        .withColumn("s", F.size("item_words") - (SHINGLE - 1))
    )
    keyed = items.select(F.xxhash64("item_words").alias("item"), "s", "item_words", "item_ids")
    vocabulary = stored(keyed.select("item", "s", F.explode(F.array_distinct(shingle_hashes(F.col("item_words")))).alias("h")))
    n_vocabulary, longest = vocabulary.agg(F.count(F.lit(1)), F.max("s")).first()
    # Broadcast only up to a checked number of rows (20 bytes each); else the join is shuffled.
    known = F.broadcast(vocabulary) if n_vocabulary <= broadcast_rows else vocabulary
    # A piece holds the words of all windows that start in its stretch; at least half of them are its own.
    longest = longest or 0
    stretch = max(STRETCH, longest)

    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text_hash"), F.col(text_col).alias("_text"))
    worded = rows.select(*_KEY, words_of("_text").alias("words"))  # by itself: shingles use it many times
    worded = worded.select("*", F.size("words").alias("_n"))
    seeds = worded.select(*_KEY, "_n", F.posexplode(shingle_hashes(F.col("words"))).alias("pos", "h")).join(known, "h")
    # Positions of one document and item, by stretch: a row's array stays short, however long the text.
    met = seeds.groupBy(*_KEY, "_n", "item", "s", _part("pos", stretch)).agg(F.array_sort(F.collect_set("pos")).alias("positions"))
    by_part = Window.partitionBy(*_KEY, "item", "s").orderBy("part")
    all_parts = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = met.select("*", F.sum(F.size("positions")).over(all_parts).alias("_met"),
                        F.lag(F.element_at("positions", -1)).over(by_part).alias("_before")).where(
        F.col("_met") >= F.ceil(F.lit(similarity) * F.col("s") - F.lit(1e-9)))

    # The windows that an item asks for: those of its size over a position in common. Each start comes once,
    # with the first position that its window covers.
    count = F.least("s", F.col("_n") - (SHINGLE - 1))
    last = F.col("_n") - (SHINGLE - 1) - F.col("count")

    def starts_over(p: Column, i: Column) -> Column:
        before = F.coalesce(F.get("positions", i - 1), F.col("_before"), F.lit(-1))
        low, high = F.greatest(F.lit(0), p - F.col("count") + 1, before + 1), F.least(p, last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    asked = stored(shared.withColumn("count", count).select(
        *_KEY, "item", "count", F.flatten(F.transform("positions", starts_over)).alias("starts")))
    wanted = asked.select(*_KEY, "item", "count", F.explode("starts").alias("start"))

    # The pieces of the documents that are left, as text. Keys and numbers of pieces are broadcast up to a checked
    # number of pieces (24 bytes each).
    held = stored(wanted.select(*_KEY, _part("start", stretch)).distinct().groupBy(*_KEY).agg(F.collect_set("part").alias("parts")))
    n_held = held.agg(F.sum(F.size("parts"))).first()[0] or 0
    whole = _same_rows(rows, F.broadcast(held) if n_held <= broadcast_rows else held).select(*_KEY, "parts", words_of("_text").alias("words"))
    cut = whole.select(*_KEY, F.explode(F.transform("parts", lambda k: F.struct(k.alias("part"), F.array_join(
        F.slice("words", k * stretch + 1, stretch + longest + SHINGLE - 2), " ").alias("piece")))).alias("p"))
    texts = stored(cut.select(*_KEY, "p.part", "p.piece").dropDuplicates([*_KEY, "part"]))
    pieces = texts.select(*_KEY, "part", F.split("piece", " ").alias("words"))

    # Windows of one size over one text: each start once, however many items it is for. Rows hold windows, never a
    # text: an array next to an explode would be copied into every row that it gives.
    sized = wanted.select(*_KEY, "count", "start").distinct().select("*", _part("start", stretch))
    hashed = pieces.select(*_KEY, "part", shingle_hashes(F.col("words")).alias("hashes"))
    at = F.col("start") - F.col("part") * stretch + 1
    windows = _same_rows(sized, hashed, ["part"]).select(*_KEY, "count", "start", F.slice("hashes", at, F.col("count")).alias("own"))
    prints = simhash_of(windows, [*_KEY, "count", "start"], "own")
    item_prints = simhash_of(keyed.select("item", shingle_hashes(F.col("item_words")).alias("own")), ["item"], "own")

    # A window is looked up in the lists of the items that asked for it, so that what is met grows with
    # the items that a document shares, not with the benchmark.
    plan = block_plan(radius)
    probed = _same_rows(prints, wanted, ["count", "start"]).select(*_KEY, "item", "count", "start", "fp", F.posexplode(
        F.array(*[_block(F.col("fp"), bits) for bits, _ in plan])).alias("block", "key"))
    listed = item_prints.select("item", F.col("fp").alias("item_fp"), F.posexplode(
        F.array(*[_within(_block(F.col("fp"), bits), bits, r) for bits, r in plan])).alias("block", "keys")).select(
        "item", "item_fp", "block", F.explode("keys").alias("key"))
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # The list grows with the benchmark and has no bound: both sides are shuffled.
    candidates = probed.join(listed.hint("merge"), ["item", "block", "key"]).where(apart <= radius).select(
        *_KEY, "count", "start", "item").distinct()

    own = _same_rows(candidates.select("*", _part("start", stretch)), pieces, ["part"]).select(
        *_KEY, "item", "count", "start", F.slice("words", at, F.col("count") + (SHINGLE - 1)).alias("own"))
    bags = keyed.select("item", "s", bag(F.col("item_words"), F.lit(0), F.col("s")).alias("item_bag"))
    # Shingles as texts take some 100 bytes each.
    judged = own.join(F.broadcast(bags) if n_vocabulary <= broadcast_rows // 10 else bags, "item")
    both = F.size(F.array_intersect(bag(F.col("own"), F.lit(0), F.col("count")), "item_bag"))
    scored = judged.withColumn("both", both).withColumn(
        "similarity", F.col("both") / (F.col("count") + F.col("s") - F.col("both")))
    best = scored.where(F.col("similarity") >= similarity).groupBy(*_KEY, "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("before"))).alias("b"))
    ids = keyed.select("item", F.explode("item_ids").alias("i")).select("item", "i.item_id")
    return best.join(ids, "item").groupBy(*_KEY, "item_id").agg(F.max("b").alias("b")).select(
        *_KEY, "item_id", "b.similarity", (-F.col("b.before")).alias("start_word"))


def _part(at: str, stretch: int) -> Column:
    """``part``: the number of the stretch that a position is in."""
    return F.floor(F.col(at) / F.lit(stretch)).cast("int").alias("part")


def _same_rows(left: DataFrame, right: DataFrame, more: list[str] | None = None) -> DataFrame:
    """Join on the row key, NULL ids equal (and on columns ``more``)."""
    keys = [*_KEY, *(more or [])]
    named = right.withColumnsRenamed({k: f"_r{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r{k}")) if k in _KEY else F.col(k) == F.col(f"_r{k}") for k in keys]
    return left.join(named, on).drop(*[f"_r{k}" for k in keys])


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, similarity, start_word``: one row per document and benchmark item it holds."""
    found = contamination(docs, benchmark, **options)
    return found.groupBy(F.col("_id").alias("doc_id"), "item_id").agg(F.max(F.struct("similarity", (-F.col("start_word")).alias("b"))).alias("m")).select(
        "doc_id", "item_id", "m.similarity", (-F.col("m.b")).cast("int").alias("start_word"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item, columns as given."""
    found = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    bad = stored(found.select("_id", "_text_hash").distinct()).alias("b")
    keyed = docs.select(nested(docs), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash")).alias("d")
    hit = F.col("d.id").eqNullSafe(F.col("b._id")) & (F.col("d.hash") == F.col("b._text_hash"))
    return keyed.join(F.broadcast(bad) if bad.count() <= BROADCAST_KEYS else bad, hit, "left_anti").select("d.row.*")

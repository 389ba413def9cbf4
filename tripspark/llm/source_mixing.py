"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Targets: sources in code-point order (NULL last) get the given weights in
rotation and share the total size by weight. A target stops at ``max_epochs``
times its source's size; what is over goes to the others by weight, until none
is above (water filling in one pass: sources sorted by size per weight reach
their stop in that order).

Selection: a source is first taken in complete epochs. The rest of its target
is drawn without replacement: document ``i`` gets the key ``-ln(u_i) / w_i``
with ``u_i`` uniform (from a hash of seed and id, so reruns agree) and ``w_i``
its quality weight; documents are taken in ascending key order until the budget
is met, the last one in part.

Scale: no source is ever sorted as a whole. Keys fall into logarithmic buckets
(256 an octave: none holds much over a thousandth of a source); sizes are
summed per source and bucket with partial aggregation, the bucket in which the
budget ends is found from those sums, and only its rows are sorted. What comes
out is one cut-off per source, against which every row is judged in place.

Defined cases: a NULL text has size 0; a NULL or not positive weight counts as
``1e-6``; rows that repeat a source, key, id and size are one tie and share what is left of
the budget evenly, the remainder one word each (``mixed_documents``: as many whole
rows as come nearest to it); a NULL source is a source of its own, NULL ids tie; texts are
whole, whatever their length; an empty table gives an empty result; extra columns pass
through ``mixed_documents``, whatever their names, and are ignored by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import nested, stored, text_or_empty, word_count

#: Fixed rotation of source weights.
WEIGHTS = (5, 2, 1)
_PER_OCTAVE = 256


def text_quality(text: str | Column) -> Column:
    """Quality weight of a text, 0.05 to 1: the share of letters and digits in what isn't white space."""
    t = text_or_empty(text)
    solid = F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", ""))
    plain = F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]+", ""))
    return F.when(solid > 0, F.lit(0.05) + F.lit(0.95) * plain / solid).otherwise(F.lit(0.05))


def uniform(id_col: str, seed: int) -> Column:
    """A number in (0, 1) from the id: 52 bits of an MD5 digest."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(2.0 ** 52)


def with_keys(docs: DataFrame, *, id_col: str, source_col: str, text_col: str, quality: Column, seed: int) -> DataFrame:
    """``docs`` plus ``_id, _source, _size, _key``."""
    weight = F.when(quality > 0, quality).otherwise(F.lit(1e-6))
    return docs.withColumns({
        "_id": F.col(id_col), "_source": F.col(source_col), "_size": word_count(text_col),
        "_key": -F.log(uniform(id_col, seed)) / F.coalesce(weight, F.lit(1e-6))})


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """``_source, source_size`` plus ``target``, ``epochs`` (complete ones) and ``rest`` (words after those).

    The windows below run over one row per source."""
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("_source").asc_nulls_last()))
    ranked = sizes.withColumn("w", F.element_at(F.array(*[F.lit(x) for x in weights]),
                                                ((rank - 1) % len(weights) + 1).cast("int")).cast("double"))
    # In this order sources reach their stop.
    filling = everything.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("_source").asc_nulls_last())
    stop = F.col("source_size") * F.lit(max_epochs)
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(stop).over(before), F.lit(0))).cast("double") / F.sum("w").over(after)
    full = ranked.withColumn("own", (stop.cast("double") / F.col("w") <= level).cast("int")).withColumn(
        "full", F.min("own").over(filling.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    left = (F.sum("source_size").over(everything) - F.sum(F.when(F.col("full"), stop).otherwise(F.lit(0))).over(everything)).cast("double")
    share = left / F.sum(F.when(F.col("full"), F.lit(0.0)).otherwise(F.col("w"))).over(everything)
    target = F.when(F.col("full"), stop.cast("double")).otherwise(F.col("w") * share)
    words = F.floor(F.col("target") + F.lit(0.5))
    return full.withColumn("target", target).select("_source", "source_size", "target").withColumns({
        "epochs": F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0)).cast("long"),
    }).withColumn("rest", (words - F.col("epochs") * F.col("source_size")).cast("long"))


def cut_offs(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """One row per source: its target, and the position in key order where the rest of its
    budget ends (``cut``: key, id, size), with the number of rows there (``m``) and the words they give together (``used``)."""
    bucketed = rows.select("_source", "_id", "_size", "_key",
                           F.floor(F.log2("_key") * F.lit(_PER_OCTAVE)).alias("bucket")).where("_size > 0")
    sums = stored(bucketed.groupBy("_source", "bucket").agg(F.sum("_size").alias("s")))
    sizes = rows.select("_source").distinct().alias("r").join(
        sums.groupBy("_source").agg(F.sum("s").alias("n")).alias("s"),
        F.col("r._source").eqNullSafe(F.col("s._source")), "left").select(
        F.col("r._source").alias("_source"), F.coalesce("n", F.lit(0)).alias("source_size"))
    targets = stored(source_targets(sizes, weights, max_epochs))

    along = Window.partitionBy("_source").orderBy("bucket")
    upto = sums.withColumn("upto", F.sum("s").over(along)).alias("b").join(
        targets.alias("t"), F.col("b._source").eqNullSafe(F.col("t._source")))
    ends = upto.where((F.col("upto") - F.col("s") <= F.col("rest")) & (F.col("rest") < F.col("upto"))).select(
        F.col("t._source").alias("end_source"), F.col("bucket").alias("end_bucket"),
        (F.col("rest") - F.col("upto") + F.col("s")).alias("left"))
    # Only the rows of the bucket in which a source's budget ends; equal rows are counted, not listed.
    last = bucketed.join(ends, F.col("_source").eqNullSafe(F.col("end_source")) & (F.col("bucket") == F.col("end_bucket")))
    ties = last.groupBy("end_source", "left", "_key", "_id", "_size").agg(F.count(F.lit(1)).alias("m"))
    order = Window.partitionBy("end_source").orderBy("_key", F.col("_id").asc_nulls_first(), "_size")
    own = F.col("m") * F.col("_size")
    spent = ties.withColumn("upto", F.sum(own).over(order)).where(
        (F.col("upto") - own <= F.col("left")) & (F.col("left") < F.col("upto")))
    cuts = spent.select("end_source", F.struct("_key", "_id", "_size").alias("cut"),
                        "m", (F.col("left") - F.col("upto") + own).alias("used"))
    return stored(targets.join(cuts, F.col("_source").eqNullSafe(F.col("end_source")), "left").select(
        F.col("_source").alias("cut_source"), "source_size", "target", "epochs", "cut", "m", "used"))


def _judged(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` with their source's cut-off, ``tied`` (at the cut with others) and ``part`` (words of the fractional
    pass; of a tied row: NULL)."""
    own = F.struct("_key", "_id", "_size")
    at = (F.col("_size") > 0) & F.coalesce(own == F.col("cut"), F.lit(False))
    part = F.when(at & (F.col("m") > 1), None).when(at, F.col("used")).when(
        (F.col("_size") > 0) & F.coalesce(own < F.col("cut"), F.lit(False)), F.col("_size")).otherwise(F.lit(0))
    return rows.join(cuts, F.col("_source").eqNullSafe(F.col("cut_source"))).withColumns({
        "tied": at & (F.col("m") > 1), "part": part.cast("long")})


#: Rows of a tie that one task lists.
_LISTED = 1 << 16


def _tied_rows(cuts: DataFrame) -> DataFrame:
    """The rows of each tie at a cut, equal but for ``part``: counted before, listed here in stretches."""
    ties = cuts.where("m > 1").select("source_size", "target", "epochs", "cut.*", "m", "used", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / F.lit(_LISTED)))).alias("stretch"))
    first = F.col("stretch") * F.lit(_LISTED)
    listed = ties.repartition("_key", "stretch").withColumn(
        "rank", F.explode(F.sequence(first, F.least(first + F.lit(_LISTED), F.col("m")) - 1)))
    share = F.floor(F.col("used") / F.col("m"))
    return listed.withColumn("part", (share + (F.col("rank") < F.col("used") - share * F.col("m")).cast("long")).cast("long"))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: int = 7,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        quality: Column | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, epochs, taken``: one row per document;
    ``taken`` counts words, repeats included."""
    quality = text_quality(text_col) if quality is None else quality
    rows = stored(with_keys(docs, id_col=id_col, source_col=source_col, text_col=text_col, quality=quality,
                            seed=seed).select("_id", "_source", "_size", "_key"))
    cuts = cut_offs(rows, weights, max_epochs)
    names = ["_id", "_size", "source_size", "target", "epochs", "part"]
    judged = _judged(rows, cuts).where(~F.col("tied")).select(*names).unionByName(_tied_rows(cuts).select(*names))
    return judged.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", "epochs",
                         (F.col("epochs") * F.col("_size") + F.col("part")).alias("taken"))


def mixed_documents(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: int = 7,
                    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    quality: Column | None = None) -> DataFrame:
    """The mix itself, columns as given: every document once per complete epoch and once more if
    the fractional pass takes it. Documents stay whole: the one at the cut is taken if at least half of it fits;
    of a tie there, as many rows as come nearest to what is left."""
    quality = text_quality(text_col) if quality is None else quality
    own = docs.select(nested(docs, "_row"), F.col(id_col).alias("i"), F.col(source_col).alias("s"),
                      F.col(text_col).alias("t"), quality.alias("q"))
    keyed = with_keys(own, id_col="i", source_col="s", text_col="t", quality=F.col("q"), seed=seed).select(
        "_row", "_id", "_source", "_size", "_key")
    cuts = cut_offs(stored(keyed.drop("_row")), weights, max_epochs)
    judged = _judged(keyed, cuts)
    # Half or more of the row at the cut counts as one copy; every other part is all or nothing.
    copies = F.col("epochs") + ((F.col("part") > 0) & (2 * F.col("part") >= F.col("_size"))).cast("long")
    single = judged.where(~F.col("tied")).select("_row", copies.alias("copies"))
    mixed = single
    if not cuts.where("m > 1").isEmpty():
        # Equal rows of a tie are counted and the wanted number of copies is handed out along them.
        equal = judged.where("tied").groupBy("_row", "_source").agg(
            F.count(F.lit(1)).alias("c"), F.min("epochs").alias("epochs"),
            F.min(F.floor(F.col("used") / F.col("_size") + F.lit(0.5))).alias("wanted"))
        along = Window.partitionBy("_source").orderBy(F.xxhash64("_row"), "_row").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("c").over(along), F.lit(0))
        handed = F.greatest(F.lit(0), F.least(F.col("c"), F.col("wanted") - before))
        mixed = single.unionByName(equal.select("_row", (F.col("epochs") * F.col("c") + handed).cast("long").alias("copies")))
    return mixed.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS solid,
    length(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}]+', '', 'g')) AS plain,
    (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
k AS (SELECT doc_id, source, size,
    -ln(u) / (CASE WHEN solid > 0 THEN 0.05::DOUBLE + 0.95::DOUBLE * plain / solid ELSE 0.05::DOUBLE END) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS w FROM s),
l AS (SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS r,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT *, bool_and((3 * source_size)::DOUBLE / w <= level) OVER (ORDER BY r) AS is_full FROM l),
t AS (SELECT source, source_size, CASE WHEN is_full THEN (3 * source_size)::DOUBLE ELSE w * (
    (sum(source_size) OVER () - sum(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE
    / sum(CASE WHEN is_full THEN 0.0::DOUBLE ELSE w END) OVER ()) END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN (floor(target + 0.5)::BIGINT // source_size) ELSE 0 END AS epochs FROM t),
o AS (SELECT k.*, source_size, target, epochs, floor(target + 0.5)::BIGINT - epochs * source_size AS rest,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, size) AS upto,
    count(*) OVER (PARTITION BY k.source, key, doc_id, size) AS m,
    row_number() OVER (PARTITION BY k.source, key, doc_id, size) AS i
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, epochs::BIGINT AS epochs,
  (epochs * size + least(size, u // m + CASE WHEN i <= u % m THEN 1 ELSE 0 END))::BIGINT AS taken
FROM (SELECT *, greatest(0, rest - (upto - m * size)) AS u FROM o)
"""

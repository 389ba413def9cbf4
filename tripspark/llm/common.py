"""Helpers shared by the operators: words, row keys, checkpoints, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.session import shared_dir

#: A word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(col: str | Column) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(text: str | Column) -> Column:
    """Number of words (NULL or empty text: 0), a long."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder: later
    reads don't recompute it and survive the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc32_mod(col: str, n: int) -> Column:
    """crc32 of the column's text form, modulo ``n`` (NULL stays NULL)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def signed(x: int) -> int:
    """An unsigned 64-bit number as the long with the same bits."""
    return x - (1 << 64) if x >> 63 else x


def within_flips(key: Column, bits: list[int], radius: int) -> Column:
    """Array of all values within ``radius`` flips of ``bits``: one flip, or none, at a time, so that the
    plan holds one short array however many values there are."""
    flips = F.array(*[F.lit(x).cast("long") for x in (0, *[signed(1 << b) for b in bits])])
    near = F.array(key)
    for _ in range(radius):
        near = F.array_distinct(F.flatten(F.transform(near, lambda k: F.transform(flips, lambda m: k.bitwiseXOR(m)))))
    return near


def nested(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that their names can't clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


#: Keys of rows (id, hash and length of the text: about 32 bytes) are broadcast up to so many, counted first.
BROADCAST_KEYS = 1_000_000


def row_key(id_col: str, text_col: str) -> list[Column]:
    """``key_id, key_hash, key_length``: what tells a document's row from others (rows of one id and text are equal)."""
    text = text_or_empty(text_col)
    return [F.col(id_col).alias("key_id"), F.xxhash64(text).alias("key_hash"), F.length(text).alias("key_length")]


def without_rows(docs: DataFrame, gone: DataFrame, *, id_col: str, text_col: str, keep: bool = False) -> DataFrame:
    """``docs`` without (or with only, if ``keep``) the rows of the keys ``gone`` (:func:`row_key`, each once; small
    or a stored table). The texts are shuffled only if the keys are too many to broadcast."""
    keyed = docs.select(nested(docs), *row_key(id_col, text_col)).alias("d")
    gone = (F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone).alias("g")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}")) for k in ("key_id", "key_hash", "key_length")]
    return keyed.join(gone, same, "left_semi" if keep else "left_anti").select("d.row.*")


#: Up to so many links (16 bytes each) components are found by one task's union-find; counted first.
ONE_TASK_LINKS = 2_000_000


def connected_components(edges: DataFrame, one_task_links: int = ONE_TASK_LINKS) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges`` (longs ``a``, ``b``);
    ``root`` is the smallest node of its component.

    A counted, bounded number of links goes through one task's union-find: no
    shuffle, one job. Beyond it, alternating large-star and small-star steps
    until the edges stop changing: each round replaces a node's links by links to
    its smallest neighbour, so the edge count never grows and long chains shrink
    by halves. Neighbour minima come from partial aggregates and are joined back,
    so a hub is neither gathered in one row nor in one group; each round is
    checkpointed. Both ways give the same rows.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(e)
    if mark[0] <= one_task_links:
        return stored(e.coalesce(1).mapInArrow(_roots, "node bigint, root bigint"))
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        e = stored(small)
        before, mark = mark, _mark(e)
        if mark == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over links ``(u, v)``; the smaller root wins."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (above := up.setdefault(top, top)) != top:
            top = above
        while x != top:
            up[x], x = top, up[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    nodes = list(up)
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())],
                                         names=["node", "root"])


def running(rows: DataFrame, key: list[str], at: str, values: dict[str, tuple[Callable[[Column], Column], Column]], *,
            descending: bool = False, width: int = 4096) -> DataFrame:
    """``rows`` with running totals: per ``key``, over rows up to and with this one in the order of the
    long ``at`` (unique per key). ``values``: name -> (aggregate function, column); the function
    combines its own results (``F.sum``, ``F.bit_xor``).

    No key is gathered in one task: totals of stretches of ``width`` come from partial aggregation,
    only these are accumulated per key, and a window runs inside each stretch."""
    stretch = F.floor(F.col(at) / F.lit(width)).alias("_stretch")
    cut = rows.select("*", stretch)
    order = (lambda c: F.col(c).desc()) if descending else F.col
    totals = cut.groupBy(*key, "_stretch").agg(*[f(c).alias(f"_t_{n}") for n, (f, c) in values.items()])
    before = Window.partitionBy(*key).orderBy(order("_stretch")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*key, "_stretch", *[f(F.col(f"_t_{n}")).over(before).alias(f"_c_{n}") for n, (f, _) in values.items()])
    inside = Window.partitionBy(*key, "_stretch").orderBy(order(at))
    own = cut.select("*", *[f(c).over(inside).alias(f"_o_{n}") for n, (f, c) in values.items()])
    joined = own.join(carried, [*key, "_stretch"])
    return joined.select(*rows.columns, *[_combine(f, F.col(f"_c_{n}"), F.col(f"_o_{n}")).alias(n) for n, (f, _) in values.items()])


def _combine(function: Callable[[Column], Column], a: Column, b: Column) -> Column:
    zero = F.lit(0).cast("long")
    a, b = F.coalesce(a, zero), F.coalesce(b, zero)
    return a.bitwiseXOR(b) if function is F.bit_xor else a + b


def _mark(e: DataFrame) -> tuple:
    """Count and order-free hash of an edge set: equal sets, equal marks."""
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                       F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())

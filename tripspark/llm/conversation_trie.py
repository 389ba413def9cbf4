"""Prefix trie of conversations by fixed-length block hashing.

1. Turns get their place in the conversation from one range sort; a turn is then
   two 64-bit hashes and a word count, the text goes no further.
2. A sequence of turns is named by its depth and two XORs of hashes that mix place and
   turn (128 bits). So a block of :data:`BLOCK` turns has a digest of its own, and
   the digest at its end is the XOR over the conversation's blocks so far.
3. Conversations are grouped by their successive block digests first: one row per
   distinct (block number, digest at its start, digest at its end), with the number of
   conversations, the smallest of them and the block's turns.
4. Where all that go on from a block's start go through one block, its turns are
   trie nodes as they are. Only inside blocks in which siblings diverge are turn
   boundaries refined: the distinct blocks (not the conversations) are spread
   into turns and grouped by the digest at each turn.
5. Nodes whose smallest member is the same conversation form a segment of its path.
   Segments hang in a tree; sums over subtrees are the sums of hanging segments,
   doubled in reach each round, plus running sums along each segment.
6. Ids of the conversations that end in a node are sorted, joined in stretches
   and hashed as a stream.

Skew: a common first turn or a group of copies is one group under partial aggregation;
a very long conversation is cut by the range sort, and its running values come from
stretches (:func:`~tripspark.llm.common.running`). Only the SHA-256 over the ids
of one node is the work of one task, over ready strings of up to 65,536 ids.

Defined cases: rows without conversation id belong to none and are left out; NULL turns
come first, rows of one turn are ordered by role, then text; repeated rows are turns
of their own; NULL role or text is empty; texts are whole, whatever their length; a
conversation whose rebuilt form has no turns is a member of the root alone; an empty table
has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import running, stored, text_or_empty, word_count

#: Turns in a block.
BLOCK = 4
_PIECE = 1 << 16


def placed_turns(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(conv, part, at, g1, g2, words)``, the turns in order with ``at`` counted inside a part of the
    sort, and ``(conv, part, first, before, n)``, what a part holds of a conversation."""
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    row = F.monotonically_increasing_id()
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", row.alias("at"), F.xxhash64("role", "text").alias("g1"), F.xxhash64("text", F.lit("|"), "role").alias("g2"),
        word_count("text").alias("words")))
    placed = placed.withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    return placed, stored(parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long"))))


def rebuilt_turns(turns: DataFrame, *, family: int = 20, heads: int = 4, **columns: str) -> tuple[DataFrame, DataFrame]:
    """``(conv, depth, g1, g2, words, length)``, the turns of every rebuilt conversation, and ``(conv, length)``.
    The first ``h`` turns of conversation ``c`` come from conversation ``c - c % family``; ``h`` = crc32(c) % ``heads``."""
    placed, parts = placed_turns(turns, **columns)
    sizes = parts.groupBy("conv").agg(F.sum("n").alias("own")).withColumns({
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % heads, "base": F.col("conv") - F.col("conv") % family})
    bases = sizes.select(F.col("conv").alias("base"), F.col("own").alias("lent"))
    convs = stored(sizes.join(bases, "base", "left").withColumn(
        "lent", F.least("h", F.coalesce("lent", F.lit(0).cast("long")))).withColumn(
        "length", F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long"))))
    places = parts.join(convs.select("conv", "h", "lent", "length"), "conv")
    at = placed.join(places, ["conv", "part"]).withColumn("place", F.col("before") + F.col("at") - F.col("first") + 1)
    own = at.where("place > h").select("conv", (F.col("lent") + F.col("place") - F.col("h")).alias("depth"), "g1", "g2", "words", "length")
    first = at.where(F.col("place") < heads).select(F.col("conv").alias("base"), F.col("place").alias("depth"), "g1", "g2", "words")
    lent = convs.select("conv", "base", "h", "length").join(first, "base").where("depth <= h").select(
        "conv", "depth", "g1", "g2", "words", "length")
    return own.unionByName(lent), convs.select("conv", "length")


def block_groups(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Distinct blocks ``(k, s1, s2, e1, e2, n_convs, conv, turns)`` and where conversations
    end, ``(conv, depth, d1, d2)``."""
    mixed = rows.select("conv", "length", "depth", F.floor((F.col("depth") - 1) / F.lit(block)).alias("k"),
                        F.xxhash64("depth", "g1").alias("x1"), F.xxhash64("g2", "depth").alias("x2"), "words")
    own = mixed.groupBy("conv", "k").agg(  # at most ``block`` turns each
        F.sort_array(F.collect_list(F.struct("depth", "x1", "x2", "words"))).alias("turns"),
        F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.max("length").alias("length"))
    chained = stored(running(own, ["conv"], "k", {"e1": (F.bit_xor, F.col("b1")), "e2": (F.bit_xor, F.col("b2"))}))
    starts = {f"s{i}": F.col(f"e{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)}
    groups = chained.withColumns(starts).groupBy("k", "s1", "s2", "e1", "e2").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.first("turns").alias("turns"))
    ends = chained.where(F.col("k") == F.floor((F.col("length") - 1) / F.lit(block))).select(
        "conv", F.col("length").alias("depth"), F.col("e1").alias("d1"), F.col("e2").alias("d2"))
    return stored(groups), ends


def trie_nodes(groups: DataFrame, convs: DataFrame) -> DataFrame:
    """``(depth, d1, d2, p1, p2, conv, n_convs, words)``: the root and a node per distinct sequence of turns."""
    siblings = groups.groupBy("k", "s1", "s2").agg((F.count(F.lit(1)) > 1).alias("diverge"))
    numbered = groups.join(siblings, ["k", "s1", "s2"]).select("*", F.posexplode("turns").alias("i", "t"))

    def upto(name: str, start: str, count: Column) -> Column:
        return F.aggregate(F.slice("turns", 1, count), F.col(start), lambda a, t: a.bitwiseXOR(t[name]))

    nodes = numbered.select(
        F.col("t.depth").alias("depth"), upto("x1", "s1", F.col("i") + 1).alias("d1"), upto("x2", "s2", F.col("i") + 1).alias("d2"),
        upto("x1", "s1", F.col("i")).alias("p1"), upto("x2", "s2", F.col("i")).alias("p2"), "conv", "n_convs",
        F.col("t.words").alias("words"), "diverge")
    names = ["depth", "d1", "d2", "p1", "p2", "conv", "n_convs", "words"]
    refined = nodes.where("diverge").groupBy("depth", "d1", "d2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv").alias("conv"), F.sum("n_convs").alias("n_convs"),
        F.min("words").alias("words"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(c) for c in names[:5]], "conv", "n_convs", zero.alias("words"))
    return stored(nodes.where("not diverge").select(*names).unionByName(refined.select(*names)).unionByName(root))


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` (one row per node: ``conv, depth, parent_conv, saved, leaf``) with ``saved`` and ``leaf``
    summed over each node's subtree."""
    sums = ["saved", "leaf"]
    own = nodes.groupBy("conv").agg(*[F.sum(c).alias(c) for c in sums])
    # A conversation's nodes are one stretch of its path; the first hangs on another conversation's.
    heads = nodes.where((F.col("depth") > 0) & (F.col("parent_conv") != F.col("conv"))).select(
        "conv", F.col("parent_conv").alias("up"), (F.col("depth") - 1).alias("hangs"))
    reach = stored(own.join(heads, "conv", "left").withColumn("jump", F.col("up")))
    while not reach.where("jump is not null").isEmpty():  # segments within 2 ** round steps are summed
        lifted = reach.where("jump is not null").groupBy(F.col("jump").alias("conv")).agg(*[F.sum(c).alias(f"_{c}") for c in sums])
        above = reach.select(F.col("conv").alias("jump"), F.col("jump").alias("next"))
        reach = stored(reach.join(lifted, "conv", "left").join(above, "jump", "left").select(
            "conv", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums], "up", "hangs", F.col("next").alias("jump")))
    hung = reach.where("up is not null").groupBy(F.col("up").alias("conv"), F.col("hangs").alias("depth")).agg(
        *[F.sum(c).alias(f"_{c}") for c in sums])
    along = nodes.drop(*sums).join(
        nodes.select("conv", "depth", *sums).join(hung, ["conv", "depth"], "left").select(
            "conv", "depth", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(f"own_{c}") for c in sums]), ["conv", "depth"])
    total = running(along, ["conv"], "depth", {c: (F.sum, F.col(f"own_{c}")) for c in sums}, descending=True)
    return total.drop(*[f"own_{c}" for c in sums])


def id_digests(ends: DataFrame) -> DataFrame:
    """``(depth, d1, d2, ends_sha256)``: SHA-256 of the ids that end in a node, ascending, comma-joined."""
    order = ["depth", "d1", "d2", "conv"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _joined_ids, "depth bigint, d1 bigint, d2 bigint, conv bigint, ids string")
    return pieces.repartition("depth", "d1", "d2").sortWithinPartitions(*order).mapInArrow(
        _hashed_ids, "depth bigint, d1 bigint, d2 bigint, ends_sha256 string")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids -> comma-joined stretches of one node's ids, with the first of each."""
    kind = pa.schema([(c, pa.int64()) for c in ("depth", "d1", "d2", "conv")] + [("ids", pa.string())])
    node, ids, out = None, [], []
    for batch in batches:
        for *own, conv in zip(*[c.to_pylist() for c in batch.columns]):
            if own != node or len(ids) >= _PIECE:
                if ids:
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                node, ids = own, []
            ids.append(conv)
        if len(out) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)
            out = []
    if ids:
        out.append((*node, ids[0], ",".join(map(str, ids))))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([(c, pa.int64()) for c in ("depth", "d1", "d2")] + [("ends_sha256", pa.string())])
    node, sha, out = None, None, []

    def table() -> pa.RecordBatch:
        rows, out[:] = list(out), []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    for batch in batches:
        for *own, _conv, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if own != node:
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                    if len(out) >= 4096:
                        yield table()
                node, sha = own, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
    if node is not None:
        out.append((*node, sha.hexdigest()))
        yield table()


def prefix_trie(turns: DataFrame, *, block: int = BLOCK, family: int = 20, heads: int = 4, **columns: str) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``."""
    rows, convs = rebuilt_turns(turns, family=family, heads=heads, **columns)
    groups, ends = block_groups(rows, block)
    nodes = trie_nodes(groups, convs)
    zero = F.lit(0).cast("long")
    ends = ends.unionByName(convs.where("length = 0").select("conv", *[zero.alias(c) for c in ("depth", "d1", "d2")]))

    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"),
                         F.col("conv").alias("parent_conv"))
    full = nodes.join(kids, ["depth", "d1", "d2"], "left").join(id_digests(ends), ["depth", "d1", "d2"], "left").join(
        above, ["depth", "p1", "p2"], "left")
    full = stored(full.select(
        "conv", "depth", F.when(F.col("depth") > 0, F.col("parent_conv")).alias("parent_conv"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.col("n_children").isNull().cast("long").alias("leaf")))
    return subtree_sums(full).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256")


ORACLE = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
z AS (SELECT DISTINCT c, c - c % 20 AS b, c::VARCHAR AS s FROM t),
c AS (SELECT c, b, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, len(s) + 1),
    lambda i: [ord(s[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h FROM z),
l AS (SELECT c.*, least(h, (SELECT count(*) FROM t WHERE t.c = c.b)) AS lent FROM c),
r AS (SELECT l.c, p AS d, role, text FROM l JOIN t ON t.c = l.b AND p <= h
  UNION ALL SELECT l.c, lent + p - h, role, text FROM l JOIN t ON t.c = l.c AND p > h),
k AS (SELECT c, d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
    list({'r': role, 't': text}) OVER (PARTITION BY c ORDER BY d) AS path FROM r
  UNION ALL SELECT c, 0, 0, [] FROM c),
n AS (SELECT path, d, min(c) AS c, count(*) AS n, any_value(w) AS w FROM k GROUP BY path, d),
e AS (SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT c, d, path, max(d) OVER (PARTITION BY c) AS m FROM k) WHERE d = m GROUP BY path),
kids AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, coalesce(ids, '') AS ids FROM n LEFT JOIN kids USING (path) LEFT JOIN e USING (path)),
s AS (SELECT a.path, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n - 1) * u.w) AS saved
  FROM f u, unnest(range(0, u.d + 1)) AS x(i) JOIN f a ON a.path = u.path[1:x.i] GROUP BY a.path)
SELECT f.c AS conv_id, f.d::BIGINT AS depth, q.c AS parent_conv_id, f.n::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(f.ids) AS ends_sha256
FROM f JOIN s USING (path) LEFT JOIN f q ON f.d > 0 AND q.path = f.path[1:f.d - 1]
"""

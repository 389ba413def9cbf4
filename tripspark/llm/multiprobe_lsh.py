"""Approximate nearest neighbours by multi-probe p-stable hashing.

1. Equal vectors form one class, which stands in the index once, with as many
   of its smallest ids as an answer can need; copies cost nothing more.
2. Each table hashes a vector to the cells of several Gaussian projections (the
   2-stable case for Euclidean distance). Every class is indexed in every table.
3. A query visits its own bucket and the perturbed buckets, one cell up or down
   on any projections, in the order of the sum of squared distances to the cell
   walls, the estimate of how likely a bucket holds a near vector.
4. The distances at which queries have their ``k`` neighbours are measured for a
   bounded sample of queries (``sample_rows``) against all rows. They give one or
   more ranges, smallest first, as density differs: cells in proportion to the
   range, and as many probes as pairs at that distance need to meet in some table
   with at least ``target`` probability. A query whose answer does not lie within
   the range goes on to the next, and from the last to all rows, exactly. Every
   row is indexed and searched whatever the sample.
5. Buckets meet their probes in groups of bounded size: a bucket with many
   vectors or many probes is split on both sides, and each part of one meets
   each part of the other. A vector goes to a group once. A group returns each query's nearest only; these are
   merged over groups and tables and ranked by their exact distance.

Defined cases: NULL, empty or zero vectors and vectors with NULL or non-finite
components take no part; vectors of another length than the query's are no
candidates; equal distances go to the smaller id; a query never finds its own
id, but finds copies of it; rows that repeat an id are one; with fewer
candidates than ``k`` all of them come back; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import stored

_SEED = 11
_GROUP = 20_000  # rows of one side of a group, about


@dataclass(frozen=True)
class Hashing:
    """``tables`` hash tables of ``projections`` projections with cells of ``width``; ``probes`` buckets a table."""

    tables: int
    projections: int
    width: float
    probes: int

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """Position in cells, ``(vectors, tables, projections)``."""
        rng = np.random.default_rng([_SEED, vectors.shape[1]])
        lines = rng.normal(size=(vectors.shape[1], self.tables * self.projections))
        shift = rng.uniform(0, 1, self.tables * self.projections)
        return (vectors @ lines / self.width + shift).reshape(len(vectors), self.tables, self.projections)

    def moves(self) -> np.ndarray:
        """All perturbations: -1, 0 or 1 on each projection."""
        return np.array(list(product((0, -1, 1), repeat=self.projections)))

    def penalties(self, cells: np.ndarray) -> np.ndarray:
        """Per vector, table and move: the sum of squared distances to the walls that it crosses."""
        inside, moves = cells - np.floor(cells), self.moves()
        down, up = (moves == -1).astype(float), (moves == 1).astype(float)
        return inside ** 2 @ down.T + (1 - inside) ** 2 @ up.T


def codes(cells: np.ndarray) -> np.ndarray:
    """One number per bucket: ten bits a projection."""
    whole = np.floor(cells).astype(np.int64) & 1023
    return (whole << (10 * np.arange(cells.shape[-1]))).sum(axis=-1)


def ranges(distances: list[float], *, common: float = 0.98, least: float = 0.05) -> list[float]:
    """Ranges to search, ascending, from sampled queries' distances to their ``k``-th neighbours: the
    ``common`` quantile, and smaller by half or more each, down to where under a share ``least`` is left."""
    d = np.sort(np.array([x for x in distances if x > 0]))
    if not len(d):
        return [0.0] if distances else []
    out = [float(np.quantile(d, common, method="lower"))]
    while (d <= out[0] / 2).mean() >= least:
        out.insert(0, float(d[d <= out[0] / 2][-1]))
    return out


def calibrate(sample: np.ndarray, reach: float, *, tables: int, projections: int, target: float,
              width_factor: float = 1.4, trials: int = 4000) -> Hashing:
    """Width and probes for pairs ``reach`` apart. What a pair's cells are depends on its distance
    only, as the projections are Gaussian: ``trials`` directions from the sampled vectors stand for all."""
    everything = 3 ** projections
    if reach == 0:
        return Hashing(tables, projections, 1.0, 1)
    hashing = Hashing(tables, projections, width_factor * reach, everything)
    rng = np.random.default_rng(_SEED)
    own = sample[rng.integers(0, len(sample), trials)]
    away = rng.normal(size=own.shape)
    away *= reach / np.sqrt((away ** 2).sum(axis=1, keepdims=True))
    moves, ranks = hashing.moves(), []
    for at in range(0, trials, 500):
        q, x = hashing.cells(own[at:at + 500]), hashing.cells(own[at:at + 500] + away[at:at + 500])
        steps = (np.floor(x) - np.floor(q)).astype(int)
        penalties = hashing.penalties(q)
        crossed = np.where(steps == -1, (q - np.floor(q)) ** 2, np.where(steps == 1, (1 - q + np.floor(q)) ** 2, 0)).sum(axis=-1)
        rank = (penalties < crossed[..., None] - 1e-12).sum(axis=-1)
        ranks.append(np.where((np.abs(steps) <= 1).all(axis=-1), rank, everything).min(axis=1))
    probes = int(np.quantile(np.concatenate(ranks), target, method="higher")) + 1
    return Hashing(tables, projections, hashing.width, min(probes, len(moves)))


def neighbour_distances(base: DataFrame, asked: list[np.ndarray], k: int) -> list[float]:
    """Distance of each of ``asked`` to the ``k + 1``-th nearest id of all classes, its own included
    (left out where there are fewer); each task passes on what that many ids need."""
    shared = base.sparkSession.sparkContext.broadcast(asked)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries = defaultdict(list)
        for i, v in enumerate(shared.value):
            queries[len(v)].append(i)
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dim, part in batch.groupby(batch["vector"].map(len)):
                if dim not in queries:
                    continue
                x, n = np.stack([np.asarray(v, float) for v in part["vector"]]), part["n"].to_numpy(np.int64)
                q = np.stack([shared.value[i] for i in queries[dim]])
                rough = (x ** 2).sum(axis=1)[None] - 2 * q @ x.T
                top = min(len(x), k + 1)
                near = np.argpartition(rough, top - 1, axis=1)[:, :top]
                exact = np.sqrt(((x[near] - q[:, None, :]) ** 2).sum(axis=2))
                for row, i in enumerate(queries[dim]):
                    d, c = best.get(i, (np.zeros(0), np.zeros(0, np.int64)))
                    d, c = np.concatenate([d, exact[row]]), np.concatenate([c, n[near[row]]])
                    order = np.argsort(d, kind="stable")[:k + 1]
                    best[i] = d[order], c[order]
        yield pd.DataFrame([(i, a, b) for i, (d, c) in best.items() for a, b in zip(d.tolist(), c.tolist())], columns=["q", "d", "n"])

    rows = base.select("vector", F.size("ids").alias("n")).mapInPandas(nearest, "q int, d double, n bigint")
    upto = Window.partitionBy("q").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = rows.withColumn("c", F.sum("n").over(upto)).where(F.col("c") > k).groupBy("q").agg(F.min("d").alias("d"))
    return [r["d"] for r in reached.collect()]  # at most one row for each of asked


def classes_of(vectors: DataFrame, k: int, *, id_col: str, vector_col: str) -> DataFrame:
    """``rep, ids, vector``: each distinct usable vector with its ``k + 1`` smallest ids and the smallest."""
    v = F.col(vector_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).alias("id"), v.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0))
    # -0.0 and 0.0 are one number.
    usable = usable.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    one = usable.groupBy("id").agg(F.min("vector").alias("vector"))
    # A group's ids are cut to the smallest before they meet: first per slice of the ids, then over the slices.
    slices = one.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(64)))
    first = Window.partitionBy("vector", "slice").orderBy("id")
    few = slices.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    return few.groupBy("vector").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids")).select(
        F.element_at("ids", 1).alias("rep"), "ids", "vector")


_PLACED = "table int, dim int, bucket bigint, rep bigint"


def _indexed(hashing: Hashing | None, probing: bool):
    """The buckets of each class, per table (and probe); without hashing, one bucket holds all. Without the vectors."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["vector"].map(len)):
                for at in range(0, len(part), 500):
                    own = part.iloc[at:at + 500]
                    if hashing is None:
                        bucket = np.zeros((len(own), 1, 1), np.int64)
                    else:
                        cells = hashing.cells(np.stack([np.asarray(x, float) for x in own["vector"]]))
                        if probing:
                            moves = hashing.moves()
                            order = np.argsort(hashing.penalties(cells), axis=-1, kind="stable")[..., :hashing.probes]
                            cells = np.floor(cells)[:, :, None, :] + moves[order]
                        else:
                            cells = cells[:, :, None, :]
                        bucket = codes(cells)
                    n, tables, probes = bucket.shape
                    for t in range(tables):
                        yield pd.DataFrame({"table": np.int32(t), "dim": np.int32(dim), "bucket": bucket[:, t].reshape(-1),
                                            "rep": np.repeat(own["rep"].to_numpy(), probes)})
    return rows


def _by_cell(rows: pd.DataFrame) -> tuple[np.ndarray, dict[tuple, np.ndarray]]:
    """The vectors of a group's rows, one a row, and the rows listed in each cell."""
    cells = defaultdict(list)
    for row, listed in enumerate(rows["cells"]):
        for c in listed:
            cells[c["table"], c["dim"], c["bucket"], c["v"], c["q"]].append(row)
    return rows["vector"].to_numpy(), {c: np.array(r) for c, r in cells.items()}


def _met(k: int):
    """Each query's nearest classes among the buckets that a group holds."""
    def nearest(_key, index: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        best: dict[int, dict[int, float]] = defaultdict(dict)
        vectors, held = _by_cell(index)
        queries, asked = _by_cell(probes)
        ids, reps = index["rep"].to_numpy(), probes["rep"].to_numpy()
        for cell, some in asked.items():
            own = held.get(cell)
            if own is None:
                continue
            x = np.stack([np.asarray(v, float) for v in vectors[own]])
            squares = (x ** 2).sum(axis=1)
            step = max(1, (1 << 21) // len(x))
            for at in range(0, len(some), step):
                rows = some[at:at + step]
                q = np.stack([np.asarray(v, float) for v in queries[rows]])
                # Ranked roughly by squares, then exactly: all whose rough value lies within the bound on its
                # rounding of the k + 1-th are looked at, ties too.
                rough = squares[None] - 2 * q @ x.T
                top = min(len(x), k + 1)
                limit = np.partition(rough, top - 1, axis=1)[:, top - 1]
                limit = limit + 1e-12 * x.shape[1] * (squares.max() + (q ** 2).sum(axis=1))
                for i, row in enumerate(rows):
                    near = np.flatnonzero(rough[i] <= limit[i])
                    exact = np.sqrt(((x[near] - q[i]) ** 2).sum(axis=1))
                    if len(near) > top:  # the nearest, ties to smaller ids
                        first = np.lexsort((ids[own[near]], exact))[:top]
                        near, exact = near[first], exact[first]
                    best[reps[row]].update(zip(ids[own[near]].tolist(), exact.tolist()))
        out = [(q, x, d) for q, found in best.items() for d, x in sorted((d, x) for x, d in found.items())[:k + 1]]
        return pd.DataFrame(out, columns=["query", "rep", "score"])
    return nearest


def _search(base: DataFrame, asked: DataFrame, n: int, k: int, hashing: Hashing | None) -> DataFrame:
    """``query, found``: up to ``k + 1`` nearest ids (structs of ``score, vec_id``, ascending) among
    the classes that share a bucket with one of the query's probes, or without hashing among all.

    Only buckets and ids are dealt out; a class or query goes with its vector to a group once,
    however many tables and probes meet there."""
    index = base.select("rep", "vector").mapInPandas(_indexed(hashing, False), _PLACED)
    probes = asked.mapInPandas(_indexed(hashing, True), _PLACED)
    cell = ["table", "dim", "bucket"]
    # Only buckets that both sides have. Buckets that need splitting: at most one for every _GROUP rows.
    sizes = index.groupBy(*cell).agg(F.count(F.lit(1)).alias("nv")).join(
        probes.groupBy(*cell).agg(F.count(F.lit(1)).alias("nq")), cell)
    sizes = stored(sizes.select(*cell, *[F.ceil(F.col(f"n{x}") / _GROUP).cast("int").alias(f"{x}s") for x in "vq"], "nv", "nq"))
    rows = sizes.agg(F.sum(F.greatest(F.col("nv") * F.col("qs"), F.col("nq") * F.col("vs")))).first()[0] or 0
    parts = max(1, -(-rows // _GROUP))

    def placed(side: DataFrame, vectors: DataFrame, own: str, other: str) -> DataFrame:
        """Each class once a part, with its vector and its cells there: its part of a split bucket (``own``) for each
        part of the other side."""
        split = side.join(sizes, cell).withColumn(own, F.pmod(F.xxhash64("rep"), F.col(f"{own}s")).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
        dealt = split.select("rep", F.pmod(F.xxhash64(*cell, "v", "q"), F.lit(parts)).cast("int").alias("part"),
                             F.struct(*cell, "v", "q").alias("cell"))
        return dealt.groupBy("rep", "part").agg(F.collect_list("cell").alias("cells")).join(vectors.select("rep", "vector"), "rep")

    met = placed(index, base, "v", "q").groupBy("part").cogroup(placed(probes, asked, "q", "v").groupBy("part")).applyInPandas(
        _met(k), "query bigint, rep bigint, score double")
    merged = met.groupBy("query", "rep").agg(F.min("score").alias("score"))
    by_class = Window.partitionBy("query").orderBy("score", "rep")
    top = merged.withColumn("r", F.row_number().over(by_class)).where(F.col("r") <= k + 1).select("query", "rep", "score")

    # Back to ids.
    answers = top.join(base.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("query").orderBy("score", "vec_id")
    answers = answers.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
    return answers.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found"))


def neighbours(queries: DataFrame, vectors: DataFrame, k: int = 10, *, tables: int = 6, projections: int = 6,
               target: float = 0.97, sample_rows: int = 200, id_col: str = "vec_id",
               vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of ``vectors`` found for each of ``queries``."""
    base = stored(classes_of(vectors, k, id_col=id_col, vector_col=vector_col))
    asked = stored(classes_of(queries, k, id_col=id_col, vector_col=vector_col).select(
        F.col("rep"), "vector"))
    n = base.count()
    sample = [np.array(r["vector"], float) for r in asked.orderBy(F.xxhash64("vector"), "rep").limit(
        sample_rows).select("vector").collect()]  # bounded by sample_rows
    same = [v for v in sample if len(v) == len(sample[0])]

    # A range's answers count if they end within it; the other queries go on.
    open_, listed = asked, None
    for reach in ranges(neighbour_distances(base, sample, k)):
        hashing = calibrate(np.array(same), reach, tables=tables, projections=projections, target=target)
        found = _search(base, open_, n, k, hashing)
        settled = stored(found.where((F.size("found") > k) & (F.element_at("found", -1)["score"] <= reach * (1 + 1e-9))))
        listed = settled if listed is None else listed.unionByName(settled)
        open_ = stored(open_.join(settled, F.col("rep") == F.col("query"), "left_anti"))
    if not open_.isEmpty():
        rest = _search(base, open_, n, k, None)
        listed = rest if listed is None else listed.unionByName(rest)
    if listed is None:
        listed = asked.sparkSession.createDataFrame([], "query bigint, found array<struct<score: double, vec_id: bigint>>")

    # A class of queries has one answer, of which each query leaves its own id out.
    members = _members(queries, asked, id_col, vector_col).join(listed, "query")
    ranked = members.select("query_id", F.posexplode(F.slice(F.filter(
        "found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("r", "x"))
    return ranked.select("query_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                         F.col("x.score").alias("score"))


def _members(queries: DataFrame, asked: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``query, query_id``: the smallest id of a query's class, and the query."""
    plain = queries.select(F.col(id_col).alias("query_id"), F.transform(
        F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector")).groupBy("query_id").agg(
        F.min("vector").alias("vector"))
    return plain.join(asked.withColumnRenamed("rep", "query"), "vector").select("query", "query_id")

"""Top-k: a global order + limit, and an exact top-k over a join.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task keeps a
k-row heap and one task merges ``k × tasks`` rows — no global sort. Orders
always end with key tie-breaks so the k rows are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.operators.joins import broadcast_budget, is_fixed_width, reduced_by_keys, row_width
from tripspark.session import shared_dir


def _check_k(k: int) -> int:
    if int(k) <= 0:
        raise ValueError(f"k must be positive; got {k}")
    return int(k)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(_check_k(k))


def top_k_join(
    facts: DataFrame,
    dims: DataFrame,
    *,
    key: str,
    score: str,
    k: int,
    fact_cols: Sequence[str],
    dim_cols: Sequence[str],
    candidates: int | None = None,
    max_bytes: int | None = None,
    method: str = "candidates",
    reduce_dims: bool = False,
) -> DataFrame:
    """Exact ``(facts ⋈ dims).orderBy(score desc nulls last, key, dim_cols, fact_cols).limit(k)``
    without shuffling either table.

    1. Take the top ``m`` facts by ``(score desc nulls last, key)`` — a map-side
       heap per task, only ``m`` rows leave the tasks — and store them with a
       reliable checkpoint. ``m`` is bounded and the columns are fixed-width,
       so the rows are a proven-size broadcast (otherwise the shuffled form
       below is used).
    2. Drop the candidates tied with the last one: every fact row before them is
       a candidate, so duplicates cannot be half-included.
    3. Broadcast-join the rest to ``dims`` (the dimension is streamed, not
       shuffled) and store the top ``k`` of that join. If it has ``k`` rows,
       every other joined row sorts after them, so it is the answer; likewise
       if all facts were candidates.
    4. Otherwise a shuffled join + top-k, each side cut to its top k rows per
       key first (:func:`_per_key_limited_join`): facts and dimension are read
       once more at most, whatever matches.
    ``method="shuffle"`` goes straight to that shuffled form. ``reduce_dims`` drops dimension
    rows that no fact can match before it shuffles them (:func:`joins.reduced_by_keys`), for
    facts that a selective filter left.
    """
    if method not in ("candidates", "shuffle"):
        raise ValueError(f"method must be 'candidates' or 'shuffle', got {method!r}")
    k = _check_k(k)
    fact_cols = list(dict.fromkeys([key, score, *fact_cols]))
    dim_cols = [c for c in dim_cols if c != key]
    f = facts.select(*fact_cols)
    d = dims.select(key, *dim_cols)
    fact_order = [F.col(score).desc_nulls_last(), F.col(key).asc_nulls_last()]
    # Remaining fact columns close the order, so even full ties on
    # (score, key, dim_cols) come out in one deterministic order.
    rest = [c for c in fact_cols if c not in (key, score)]
    final_order = fact_order + [F.col(c).asc_nulls_last() for c in dim_cols + rest]
    m = max(int(candidates or 0), 4 * k, 16)
    fits = is_fixed_width(f.schema) and m * row_width(f.schema) <= broadcast_budget(facts, max_bytes)
    if method == "candidates" and fits:
        shared_dir(facts.sparkSession)  # reliable checkpoints need the shared folder configured
        cand = f.orderBy(*fact_order).limit(m).checkpoint(eager=True)
        exhausted = cand.count() < m
        if not exhausted:
            in_order = Window.partitionBy(F.lit(0)).orderBy(*fact_order)  # over m rows
            cand = cand.withColumn("_rank", F.rank().over(in_order)).withColumn(
                "_last", F.max("_rank").over(Window.partitionBy(F.lit(0)))).where("_rank < _last").select(*fact_cols)
        # m rows at most: one partition, so collecting them for the broadcast is one task
        joined = F.broadcast(cand.coalesce(1)).join(d, key, "inner")
        top = joined.orderBy(*final_order).limit(k).checkpoint(eager=True)
        if exhausted or top.count() >= k:
            return top
    if reduce_dims:
        d = reduced_by_keys(d, f, key, key, max_bytes=max_bytes)
    return _per_key_limited_join(f, d, key, score, dim_cols, rest, int(k)).orderBy(*final_order).limit(k)


def _per_key_limited_join(f: DataFrame, d: DataFrame, key: str, score: str, dim_cols, rest, k: int) -> DataFrame:
    """``f ⋈ d`` restricted to what can reach a global top k.

    For one key, a fact row with k better fact rows (by score desc, then the
    other fact columns) has, for every partner, k joined rows ahead of it; the
    same holds for a dimension row with k better dimension rows. So each side
    keeps its top k rows per key (``row_number() <= k``, planned with a
    map-side group limit before the shuffle): a key repeated on both sides
    yields at most k × k pairs instead of all of them.
    """
    fact_rank = Window.partitionBy(key).orderBy(
        F.col(score).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]
    )
    dim_rank = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in dim_cols])
    f_top = f.withColumn("_rank", F.row_number().over(fact_rank)).where(F.col("_rank") <= k).drop("_rank")
    d_top = d.withColumn("_rank", F.row_number().over(dim_rank)).where(F.col("_rank") <= k).drop("_rank")
    return f_top.join(d_top, key, "inner")

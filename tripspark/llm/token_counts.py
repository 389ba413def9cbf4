"""Token counts: an exact histogram of encoded lengths with suffix sums.

Each whole text is encoded once (pandas UDF, one number per document leaves
it); documents are counted per length with partial aggregation, and sums over
all longer lengths make every later question a look-up: totals, quantiles, and
what is left when every document is cut at a context limit.

Suffix sums are taken in two steps, within blocks of 1,024 lengths and over
block totals, so the only window over everything has one row per block.

Defined cases: NULL and empty texts have length 0; an empty table gives an
empty histogram, totals of 0 and NULL quantiles; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import stored
from tripspark.llm.tokens import VOCABULARY, encode

_BLOCK = 1024


def token_length(text: str | Column, vocabulary: str = VOCABULARY) -> Column:
    @F.pandas_udf("long")
    def lengths(texts: pd.Series) -> pd.Series:
        return pd.Series([len(encode(t, vocabulary)) for t in texts], dtype="int64")

    return lengths(text)


def length_histogram(docs: DataFrame, *, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``length, docs``: number of documents of each encoded length that occurs. Stored, as the sums
    read it twice and encoding is what costs."""
    return stored(docs.select(token_length(F.col(text_col), vocabulary).alias("length")).groupBy("length").agg(
        F.count(F.lit(1)).alias("docs")))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """``length, docs`` plus, per row: ``docs_from`` and ``tokens_from`` (documents of this length or
    more, and their tokens), ``tokens_at_limit`` (all documents' tokens if each is cut at this length)
    and ``share_to`` (share of documents up to this length)."""
    h = histogram.withColumn("block", F.floor(F.col("length") / _BLOCK)).withColumn("t", F.col("length") * F.col("docs"))
    blocks = h.groupBy("block").agg(F.sum("docs").alias("bd"), F.sum("t").alias("bt"))
    longer = Window.partitionBy(F.lit(0)).orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    above = blocks.select(
        "block", F.coalesce(F.sum("bd").over(longer), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("bt").over(longer), F.lit(0)).alias("t_above"),
        F.sum("bd").over(every).alias("d_all"), F.sum("bt").over(every).alias("t_all"))
    within = Window.partitionBy("block").orderBy(F.col("length").desc())
    sums = h.join(above, "block").withColumns({
        "docs_from": F.sum("docs").over(within) + F.col("d_above"),
        "tokens_from": F.sum("t").over(within) + F.col("t_above")})
    return sums.select(
        "length", "docs", "docs_from", "tokens_from",
        (F.col("t_all") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("tokens_at_limit"),
        ((F.col("d_all") - F.col("docs_from") + F.col("docs")) / F.col("d_all")).alias("share_to"))


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``limit, docs, tokens, docs_cut, tokens_left``: totals, and what is left with each context limit.
    One aggregate over the sums; every limit looks up the shortest length above it."""
    row = F.struct("docs_from", "tokens_from")
    firsts = [F.min_by(row, F.when(F.col("length") > n, F.col("length"))).alias(f"l{i}") for i, n in enumerate(limits)]
    one = sums.agg(F.coalesce(F.max("docs_from"), F.lit(0)).alias("docs"),
                   F.coalesce(F.max("tokens_from"), F.lit(0)).alias("tokens"), *firsts)

    def answer(i: int, n: int) -> Column:
        cut = F.coalesce(F.col(f"l{i}.docs_from"), F.lit(0))
        gone = F.coalesce(F.col(f"l{i}.tokens_from"), F.lit(0))
        return F.struct(F.lit(int(n)).cast("long").alias("limit"), F.col("docs"), F.col("tokens"), cut.alias("docs_cut"),
                        (F.col("tokens") - gone + F.lit(int(n)) * cut).alias("tokens_left"))

    return one.select(F.explode(F.array(*[answer(i, n) for i, n in enumerate(limits)])).alias("a")).select("a.*")


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, length``: the smallest length that at least this share of the documents doesn't exceed."""
    firsts = [F.min(F.when(F.col("share_to") >= q, F.col("length"))).alias(f"q{i}") for i, q in enumerate(shares)]
    return sums.agg(*firsts).select(F.explode(F.array(*[
        F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("length")) for i, q in enumerate(shares)])).alias("a")
    ).select("a.*")

"""Plan inspection: capture ``explain`` output and name the join operator, planned and run.

Before an action the text is the *initial* physical plan; join hints fix the
operator there and adaptive re-planning keeps a hinted strategy. After an
action on the same DataFrame it holds the *final* plan too:
:func:`run_join` runs a join and reports both, with rows, a sum and the seconds.
"""

from __future__ import annotations

import contextlib
import io
import re
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tripspark.operators.joins import join_with_strategy

JOIN_OPERATORS = (
    "BroadcastHashJoin",
    "SortMergeJoin",
    "ShuffledHashJoin",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
)
_JOIN_RE = re.compile(r"\b(" + "|".join(JOIN_OPERATORS) + r")\b")


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def physical_plan(df: DataFrame) -> str:
    text = explain_text(df, "extended")
    marker = "== Physical Plan =="
    return text[text.index(marker):] if marker in text else text


def join_operators(df: DataFrame) -> list[str]:
    """Join operators in the physical plan, top-down."""
    return _JOIN_RE.findall(physical_plan(df))


def executed_plan(df: DataFrame) -> str:
    """The physical plan that an action on ``df`` ran: the final one under adaptive execution (the planned
    one before any action, or without it)."""
    text = physical_plan(df)
    final = text.find("== Final Plan ==")
    return text[final:text.find("== Initial Plan ==", final)] if final >= 0 else text


def planned_joins(df: DataFrame) -> list[str]:
    """Join operators of the plan before adaptive execution, top-down."""
    text = physical_plan(df)
    return _JOIN_RE.findall(text[max(0, text.find("== Initial Plan ==")):])


def executed_joins(df: DataFrame) -> list[str]:
    """Join operators of :func:`executed_plan`, top-down."""
    return _JOIN_RE.findall(executed_plan(df))


@dataclass(frozen=True)
class JoinRun:
    """What one run of a join did. ``rows`` and ``measure_sum`` were counted on the way, over the whole join."""

    strategy: str
    planned: str
    executed: str
    rows: int
    measure_sum: object
    seconds: float
    preview: list[Row] = field(default_factory=list, repr=False)


def run_join(joined: DataFrame, strategy: str, *, order: Sequence[str | Column], preview_rows: int = 20,
             measure: str | None = None) -> JoinRun:
    """Run ``joined`` once: its first ``preview_rows`` rows by ``order`` come back (bounded), while an
    ``Observation`` counts all its rows. Operators are read before and after; the seconds are the action's."""
    seen = Observation(f"join-{strategy}")
    sums = [] if measure is None else [F.sum(F.col(measure)).alias("measure_sum")]
    top = joined.observe(seen, F.count(F.lit(1)).alias("rows"), *sums).orderBy(*order).limit(int(preview_rows))
    planned = (planned_joins(top) or ["none"])[0]
    t0 = time.perf_counter()
    preview = top.collect()
    seconds = time.perf_counter() - t0
    got = seen.get
    return JoinRun(strategy, planned, (executed_joins(top) or ["none"])[0], got["rows"], got.get("measure_sum"), seconds, preview)


def join_runs_report(spark: SparkSession, runs: Sequence[JoinRun], *, seconds: bool = True) -> DataFrame:
    """One row per run: ``strategy, planned_operator, join_operator`` (the one that ran), ``rows, measure_sum`` and ``seconds``."""
    rows = [(r.strategy, r.planned, r.executed, r.rows, None if r.measure_sum is None else int(r.measure_sum), r.seconds) for r in runs]
    out = spark.createDataFrame(rows, "strategy string, planned_operator string, join_operator string, rows bigint, "
                                      "measure_sum bigint, seconds double")
    return out if seconds else out.drop("seconds")


def join_operator_of(df: DataFrame) -> str | None:
    """The top-most join operator of the physical plan (``None`` if no join)."""
    ops = join_operators(df)
    return ops[0] if ops else None


def join_strategy_report(
    facts: DataFrame,
    dims: DataFrame,
    on,
    *,
    strategies=("broadcast", "merge"),
    dim_max_rows: int | None = None,
    measure: str | None = None,
) -> DataFrame:
    """One row per strategy: ``strategy``, the planned ``join_operator`` and the
    joined ``rows`` (plus ``measure_sum`` of one numeric column, if given).

    Each row's numbers come from a distributed aggregate over that strategy's
    join, so equal ``rows``/``measure_sum`` across strategies show that the
    strategies return the same bag; only the operator name is taken from the
    plan text on the driver.
    """
    parts = []
    for strategy in strategies:
        joined = join_with_strategy(facts, dims, on, strategy=strategy, dim_max_rows=dim_max_rows)
        op = join_operator_of(joined) or "none"
        aggs = [F.count(F.lit(1)).alias("rows")]
        if measure is not None:
            aggs.append(F.sum(F.col(measure)).alias("measure_sum"))
        parts.append(
            joined.agg(*aggs).select(
                F.lit(strategy).alias("strategy"), F.lit(op).alias("join_operator"), "*"
            )
        )
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report

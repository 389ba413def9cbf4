"""Quality classifier: a sparse rule ensemble compiled into Spark column expressions.

1. Text statistics are plain column expressions over the whole text.
2. A random forest of shallow trees (Spark ML) is fitted on a bounded sample of
   labelled rows (``max_rows``); each path from a root to a node is a
   conjunctive rule over statistics.
3. A lasso logistic regression (Spark ML, elastic net with mixing 1) over the
   rules' 0/1 values drives most weights to zero.
4. What is left compiles into one column expression: the logistic function of
   the intercept plus the weights of the rules that hold. Scoring is a
   projection: no shuffle, no Python.

Defined cases: NULL counts as the empty text; every ratio is 0 where its
denominator is; ids with contradicting labels, NULL ids and NULL labels teach
nothing; without both classes among the labels the score is the labelled
share of class 1 (0.5 without labels); rows that repeat an id teach once (the least
statistics of the id) and are scored each; texts are whole, whatever their length (every pattern
takes time in proportion to the text). Scores never see id, language, source
or label. Extra columns pass through ``keep_good`` and are ignored by ``score``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from math import exp, log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import stored, text_or_empty

_SPACES = r"[\x20\x09-\x0D]+"
#: Words in a block of ``distinct_word_share``.
_BLOCK = 100


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _kept_chars(text: Column, not_in: str) -> Column:
    """Number of characters left when those matching ``not_in`` go."""
    return F.length(F.regexp_replace(text, not_in, ""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever the optimiser moves the expression.
    (A filter over a projected column would otherwise be pushed below the projection, and the
    column's expression repeated at each of its uses.)"""
    return F.element_at(F.transform(F.array(value), body), 1)


def statistics(text: str | Column) -> Column:
    """Struct of the :data:`STATISTICS` of a text, doubles."""
    return _let(text_or_empty(text), lambda t: _let(_parts(t), _ratios))


def _parts(text: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in {
        "n": F.length(text),
        "words": F.filter(F.split(text, _SPACES), lambda w: w != ""),
        "lines": F.filter(F.split(text, r"\n"), lambda x: x != ""),
        "letters": _kept_chars(text, r"[^\p{L}]+"),
        "upper": _kept_chars(text, r"[^\p{Lu}]+"),
        "digits": _kept_chars(text, r"[^\p{N}]+"),
        "marks": _kept_chars(text, r"[\p{L}\p{N}\s]+"),
        "symbols": _kept_chars(text, r"[\p{L}\p{N}\s.,;:!?'\"()-]+"),
        "solid": _kept_chars(text, r"\s+"),
        "ends": F.regexp_count(text, F.lit(r"[.!?]+")),
        "repeats": F.regexp_count(text, F.lit(r"(?<!\S)(\S+)(?=\s+\1(?!\S))")),
        "marked": F.regexp_count(text, F.lit(r"(?<![^\p{L}\p{N}\s])[^\p{L}\p{N}\s]{2,}+(?!\S)")),
    }.items()])


def _ratios(p: Column) -> Column:
    n, words, lines = p["n"], p["words"], p["lines"]
    count = F.size(words)
    # Distinct words are counted in blocks, as a whole text's share falls with its length.
    starts = F.when(count > 0, F.sequence(F.lit(1), count, F.lit(_BLOCK))).otherwise(F.array().cast("array<int>"))
    distinct = F.aggregate(starts, F.lit(0), lambda a, i: a + F.size(F.array_distinct(F.slice(words, i, _BLOCK))))
    values = {
        "log_words": F.log1p(count.cast("double")),
        "letter_share": _share(p["letters"], n),
        "upper_share": _share(p["upper"], p["letters"]),
        "digit_share": _share(p["digits"], n),
        "mark_share": _share(p["marks"], n),
        "symbol_share": _share(p["symbols"], n),
        "distinct_word_share": _share(distinct, count),
        "repeat_share": _share(p["repeats"], count),
        "marked_word_share": _share(p["marked"], count),
        "mean_word_length": _share(p["solid"], count),
        "longest_word": F.coalesce(F.array_max(F.transform(words, lambda w: F.length(w))), F.lit(0)).cast("double"),
        "words_per_sentence": count / (F.lit(1.0) + p["ends"]),
        "line_repeat_share": _share(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)),
        "words_per_line": count / (F.lit(1.0) + F.size(lines)),
    }
    return F.struct(*[values[k].alias(k) for k in STATISTICS])


#: Statistics in feature order.
STATISTICS = ("log_words", "letter_share", "upper_share", "digit_share", "mark_share", "symbol_share",
              "distinct_word_share", "repeat_share", "marked_word_share", "mean_word_length", "longest_word",
              "words_per_sentence", "line_repeat_share", "words_per_line")

#: A rule: per statistic (position in STATISTICS) the open lower and closed upper bound.
Rule = tuple[tuple[int, float, float], ...]


def rule_column(rule: Rule, stats: Column) -> Column:
    """The rule as a boolean column expression over a struct of statistics."""
    out = F.lit(True)
    for i, low, high in rule:
        c = stats[STATISTICS[i]]
        if low > float("-inf"):
            out = out & (c > F.lit(low))
        if high < float("inf"):
            out = out & (c <= F.lit(high))
    return out


def tree_rules(description: str) -> list[Rule]:
    """Every path from a root to a node below it, from a forest's ``toDebugString``,
    each statistic's bounds merged, without repeats, in order of appearance."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, tuple[int, str, float]]] = []
    for line in description.splitlines():
        depth = len(line) - len(line.lstrip())
        test = re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        while path and path[-1][0] >= depth:
            path.pop()
        if not test:
            continue
        path.append((depth, (int(test[1]), test[2], float(test[3]))))
        bounds: dict[int, list[float]] = {}
        for _, (i, side, at) in path:
            own = bounds.setdefault(i, [float("-inf"), float("inf")])
            if side == ">":
                own[0] = max(own[0], at)
            else:
                own[1] = min(own[1], at)
        rules[tuple((i, *b) for i, b in sorted(bounds.items()))] = None
    return list(rules)


@dataclass(frozen=True)
class RuleEnsemble:
    """Logistic model over conjunctive rules."""

    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score_column(self, text: str | Column = "text") -> Column:
        """Score of a text, 0 to 1."""
        def total(stats: Column) -> Column:
            out = F.lit(self.intercept)
            for rule, weight in self.weights.items():
                out = out + F.when(rule_column(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-out))

        return _let(statistics(text), total)

    def score_values(self, stats: dict[str, float]) -> float:
        """The same score for one row's statistics (tests, inspection)."""
        total = self.intercept
        for rule, weight in self.weights.items():
            if all(low < stats[STATISTICS[i]] <= high for i, low, high in rule):
                total += weight
        return 1.0 / (1.0 + exp(-total))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, *, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Statistics and label (``id, s, label``) of at most ``max_rows``
    labelled documents, those of the lowest id hash; one row per id, in one partition."""
    ids = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("_other"))
        .where("label = _other").orderBy(F.xxhash64("id"), "id").limit(max_rows).select("id", "label")
    )
    # Broadcast: at most max_rows rows of an id and a label.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    stats = rows.select("id", "label", statistics("text").alias("s")).groupBy("id").agg(
        F.min("label").cast("double").alias("label"), F.min("s").alias("s"))
    return stored(stats.select("id", "s", "label").coalesce(1).sortWithinPartitions("id"))


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20_000, trees: int = 30, depth: int = 3,
        penalty: float = 0.001, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> RuleEnsemble:
    """Fit on at most ``max_rows`` labelled documents (a documented bound on the sample)."""
    sample = labelled_sample(docs, labels, max_rows, id_col=id_col, text_col=text_col, label_col=label_col)
    n, ones = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        share = (ones + 0.5) / (n + 1.0) if n else 0.5
        return RuleEnsemble(_logit(share))
    vectors = sample.select(array_to_vector(F.array(*[F.col("s")[k] for k in STATISTICS])).alias("features"), "label", "s")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, featureSubsetStrategy="onethird",
                                    minInstancesPerNode=max(1, min(20, int(n // 200))), seed=17).fit(vectors)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleEnsemble(_logit(ones / n))
    held = stored(vectors.select(array_to_vector(F.array(*[rule_column(r, F.col("s")).cast("double") for r in rules]))
                                 .alias("features"), "label"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=100, tol=1e-6).fit(held)
    weights = {r: float(w) for r, w in zip(rules, lasso.coefficients.toArray()) if w}
    return RuleEnsemble(float(lasso.intercept), weights)


def _logit(p: float) -> float:
    return log(p / (1.0 - p))


def score(docs: DataFrame, model: RuleEnsemble, *, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted``: one row per document."""
    scored = docs.select(F.col(id_col).alias("doc_id"), model.score_column(text_col).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))


def keep_good(docs: DataFrame, model: RuleEnsemble, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents with a score of ``threshold`` or more, columns as given."""
    return docs.where(model.score_column(text_col) >= F.lit(threshold))

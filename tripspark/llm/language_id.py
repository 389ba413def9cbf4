"""Language identification by interpolated Kneser-Ney character models.

1. Texts become letters in lower case with single spaces for all else. Counts of
   all four-character sequences per language are taken over every training text:
   NumPy counts within a task, which combines them over its whole partition,
   and a Spark aggregate sums them.
2. The lower orders' continuation counts, discounts (``n1 / (n1 + 2 n2)``),
   interpolated probabilities and back-off weights are DataFrame aggregates and
   joins over these counts.
3. Every counted sequence and context is in the model. Up to a counted size (``array_cells``
   and ``array_rows``) it is broadcast: per order, sorted arrays of 64-bit sequence hashes
   with a row of log-probabilities per language, and of context hashes with back-off
   weights. Beyond that it stays in tables: the sequences of the distinct texts are joined
   with them and summed per text and language.
4. A text gets the language of least cross-entropy per character. It is rejected
   as ``und`` if that exceeds what the language's own training text leads to
   expect: mean plus ``z`` standard deviations, exact over all training
   counts, for a text of that length.

Defined cases: NULL, empty and letterless texts are ``und`` with score 0, as are
all texts if nothing was learned; NULL languages teach nothing; ties go to the
language first by code point; equal rows count each; texts are whole, whatever their length (a long
one is taken in pieces that keep their context); extra columns pass through ``identify``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import nested, stored

ORDER = 4
UNKNOWN = "und"
_CHUNK = 1 << 19  # characters handled at once
_FLOOR = 1.0 / 150_000  # share of a letter that no text had
_GRAM = ("a", "b", "c", "d")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def sequences(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(grams, sizes)``: the four-character sequence that ends at each character of the
    texts, as rows of code points (0 before a text begins), and each text's number of characters."""
    joined = "\0".join([*(t.replace("\0", " ").lower() for t in texts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int64)
    codes = np.where(_letters()[codes] | (codes == 0), codes, 32)
    before = np.concatenate([[0], codes[:-1]])
    codes = codes[(codes != 32) | ((before != 32) & (before != 0))]
    grams = np.zeros((len(codes), ORDER), np.int64)
    grams[:, -1] = codes
    for k in range(ORDER - 2, -1, -1):
        grams[1:, k] = grams[:-1, k + 1]
        grams[grams[:, k + 1] == 0, k] = 0
    ends = np.flatnonzero(codes == 0)
    sizes = np.diff(np.concatenate([[-1], ends])) - 1
    return grams[codes != 0], sizes


def pieces_of(text: str) -> list[tuple[str, int]]:
    """A text in pieces of about ``_CHUNK`` characters, each with how many of its first characters belong to the piece
    before: they are the context of what follows, so that a cut changes nothing."""
    if len(text) <= _CHUNK:
        return [(text, 0)]
    # As sequences() makes them: letters in lower case, runs of all else as one space.
    codes = np.frombuffer(text.replace("\0", " ").lower().encode("utf-32-le"), "<u4")
    codes = np.where(_letters()[codes], codes, 32).astype("<u4")
    codes = codes[(codes != 32) | np.concatenate([[False], codes[:-1] != 32])]
    out = []
    for at in range(0, max(len(codes), 1), _CHUNK):
        back = min(at, ORDER - 1)
        if back and codes[at - back] == 32:
            back = min(at, ORDER)  # a piece doesn't begin with a space
        out.append((codes[at - back:at + _CHUNK].tobytes().decode("utf-32-le"), back))
    return out


def sequences_of(pieces: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`sequences` of pieces, without those that end in the piece before."""
    grams, sizes = sequences([t for t, _ in pieces])
    skips = np.minimum([k for _, k in pieces], sizes)
    if skips.any():
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        grams = grams[np.arange(len(grams)) - first >= np.repeat(skips, sizes)]
    return grams, sizes - skips


def hashes(grams: np.ndarray) -> np.ndarray:
    """Hash of each row of code points, 64 bits."""
    h = np.zeros(len(grams), np.uint64)
    for k in range(grams.shape[1]):
        h = (h ^ (grams[:, k].astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


# --- counts ----------------------------------------------------------------------------------

def _chunks(texts: Iterable[str]) -> Iterator[list[tuple[str, int]]]:
    """The pieces of the texts in groups of about ``_CHUNK`` characters."""
    held, n = [], 0
    for t in texts:
        for piece in pieces_of(t):
            held.append(piece)
            n += len(piece[0])
            if n >= _CHUNK:
                yield held
                held, n = [], 0
    if held:
        yield held


def _merged(keys: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return keys, grams[first], np.bincount(inverse, counts, len(keys)).astype(np.int64)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of sequences per language, combined over the partition (and passed on at a million rows)."""
    own: dict[str, list] = {}
    lift = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

    def out() -> Iterator[pd.DataFrame]:
        for lang, (_, grams, counts) in own.items():
            yield pd.DataFrame({"lang": lang, **{g: grams[:, k].astype(np.int32) for k, g in enumerate(_GRAM)}, "n": counts})
        own.clear()

    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            for chunk in _chunks(texts):
                grams, _ = sequences_of(chunk)
                if not len(grams):
                    continue
                new = _merged((grams.astype(np.uint64) * lift).sum(axis=1, dtype=np.uint64), grams, np.ones(len(grams)))
                own[lang] = new if lang not in own else _merged(*[np.concatenate(x) for x in zip(own[lang], new)])
        if sum(len(x[0]) for x in own.values()) > 1_000_000:
            yield from out()
    yield from out()


def sequence_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, a, b, c, d, n``: how often each sequence occurs in all of a language's texts."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInPandas(_counted, "lang string, a int, b int, c int, d int, n bigint").groupBy("lang", *_GRAM).agg(
        F.sum("n").alias("n"))


# --- Kneser-Ney ------------------------------------------------------------------------------

def kneser_ney(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per order from 1: ``(lang, gram columns, n, p)`` with interpolated probabilities, and
    ``(lang, context columns, total, backoff)``."""
    tables = [counts]
    for k in range(1, ORDER):  # continuation counts: in how many contexts one character longer
        tables.insert(0, tables[0].groupBy("lang", *_GRAM[k:]).agg(F.count(F.lit(1)).alias("n")))
    out: list[tuple[DataFrame, DataFrame]] = []
    lower = None
    for k, table in enumerate(tables, 1):
        gram = list(_GRAM[ORDER - k:])
        context = ["lang", *gram[:-1]]
        discount = table.groupBy("lang").agg(F.count(F.when(F.col("n") == 1, 1)).alias("n1"), F.count(F.when(F.col("n") == 2, 1)).alias("n2"))
        discount = discount.select("lang", F.when(F.col("n1") > 0, F.greatest(
            F.lit(0.05), F.col("n1") / (F.col("n1") + 2 * F.col("n2")) * F.lit(0.999))).otherwise(F.lit(0.5)).alias("discount"))
        totals = table.groupBy(*context).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("followers")).join(discount, "lang").select(
            *context, "total", "discount", (F.col("discount") * F.col("followers") / F.col("total")).alias("backoff"))
        rows = table.join(totals, context)
        if lower is None:
            # The share of unseen characters goes evenly to all letters and the space.
            rows = rows.withColumn("below", F.lit(_FLOOR))
        else:
            rows = rows.join(lower.withColumnRenamed("p", "below").drop("n"), ["lang", *gram[1:]])
        probs = stored(rows.select("lang", *gram, "n", (F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
                                                        + F.col("backoff") * F.col("below")).alias("p")))
        out.append((probs, totals.select(*context, "total", "backoff")))
        lower = probs
    return out


@dataclass
class LanguageModels:
    """Sorted hash arrays of all orders, or ``tables`` of :func:`kneser_ney`; see the module's description."""

    languages: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    context_keys: list[np.ndarray]
    backoff: list[np.ndarray]
    mean: np.ndarray
    deviation: np.ndarray
    floor: float
    tables: list[tuple[DataFrame, DataFrame]] | None = None

    def log_probabilities(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probability per language of each row's last character after the others."""
        if order == 0:
            return np.full((len(grams), len(self.languages)), self.floor, np.float32)
        own = grams[:, ORDER - order:]
        h = hashes(own)
        at = np.minimum(np.searchsorted(self.keys[order - 1], h), len(self.keys[order - 1]) - 1)
        found = self.keys[order - 1][at] == h
        out = self.logp[order - 1][at]
        if not found.all():
            out[~found] = self.backed_off(grams[~found], order)
        return out

    def backed_off(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Back-off weight of the context plus the next lower order."""
        h = hashes(grams[:, ORDER - order:-1])
        keys = self.context_keys[order - 1]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        weight = np.where((keys[at] == h)[:, None], self.backoff[order - 1][at], np.float32(0))
        return weight + self.log_probabilities(grams, order - 1)

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(texts x languages)`` cross-entropy per character, and each text's number of characters."""
        total = np.zeros((len(texts), len(self.languages)))
        size = np.zeros(len(texts), np.int64)
        step = max(1, (1 << 22) // max(len(self.languages), 8))
        pieces = [(k, piece) for k, t in enumerate(texts) for piece in pieces_of(t)]
        first = 0
        while first < len(pieces):
            last, n = first, 0
            while last < len(pieces) and (last == first or n + len(pieces[last][1][0]) <= step):
                n += len(pieces[last][1][0])
                last += 1
            grams, sizes = sequences_of([x for _, x in pieces[first:last]])
            owner = np.repeat(np.array([k for k, _ in pieces[first:last]]), sizes)
            for at in range(0, len(grams), step):
                logs = self.log_probabilities(grams[at:at + step])
                for j in range(len(self.languages)):
                    total[:, j] -= np.bincount(owner[at:at + step], logs[:, j], len(texts))
            np.add.at(size, [k for k, _ in pieces[first:last]], sizes)
            first = last
        return total / np.maximum(size, 1)[:, None], size


def fit(docs: DataFrame, *, array_cells: int = 8_000_000, array_rows: int = 1_000_000, text_col: str = "text",
        lang_col: str = "lang") -> LanguageModels:
    """Train on all rows of ``docs`` that have a text and a language. The model becomes arrays if its tables have
    up to ``array_rows`` rows and up to ``array_cells`` rows times languages."""
    orders = kneser_ney(stored(sequence_counts(docs, text_col=text_col, lang_col=lang_col)))
    log_p = F.log("p")
    spread = orders[-1][0].groupBy("lang").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * log_p).alias("s"), F.sum(F.col("n") * log_p * log_p).alias("q")).toPandas()
    spread = spread.sort_values("lang", key=lambda s: s.map(lambda x: x.encode()))
    langs = spread["lang"].tolist()
    number = {x: k for k, x in enumerate(langs)}
    mean = -(spread["s"] / spread["n"]).to_numpy(float)
    deviation = np.sqrt(np.maximum((spread["q"] / spread["n"]).to_numpy(float) - mean ** 2, 0))
    model = LanguageModels(langs, [], [], [], [], mean, deviation, float(np.log(_FLOOR)))
    orders = [(probs, stored(contexts)) for probs, contexts in orders]
    size = sum(x.count() for order in orders for x in order)
    if size > array_rows or size * len(langs) > array_cells:
        model.tables = orders
        return model
    for k, (probs, contexts) in enumerate(orders, 1):
        gram = list(_GRAM[ORDER - k:])

        rows = contexts.select("lang", *gram[:-1], F.log("backoff").alias("v")).toPandas()  # array_rows at most, all tables together
        h = hashes(rows[gram[:-1]].to_numpy(np.int64))
        keys = np.unique(h)
        weights = np.zeros((len(keys), len(langs)), np.float32)
        weights[np.searchsorted(keys, h), rows["lang"].map(number).to_numpy(int)] = rows["v"]
        model.context_keys.append(keys)
        model.backoff.append(weights)

        rows = probs.select("lang", *gram, F.log("p").alias("v")).toPandas()
        h = hashes(rows[gram].to_numpy(np.int64))
        keys, first = np.unique(h, return_index=True)
        full = np.zeros((len(keys), ORDER), np.int64)
        full[:, ORDER - k:] = rows[gram].to_numpy(np.int64)[first]
        # A language that hasn't seen the sequence backs off, once and for all.
        logs = model.backed_off(full, k) if len(keys) else np.zeros((0, len(langs)), np.float32)
        logs[np.searchsorted(keys, h), rows["lang"].map(number).to_numpy(int)] = rows["v"]
        model.keys.append(keys)
        model.logp.append(logs.astype(np.float32))
    return model


def identify(docs: DataFrame, model: LanguageModels, *, z: float = 4.0, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``identified``: a struct of ``nearest`` (language of least cross-entropy), ``lang``
    (the same, or ``und`` if rejected), ``score`` (0 to 1) and ``cross_entropy``."""
    if model.tables is not None:
        return _identified_by_tables(docs, model, z, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("nearest string, lang string, score double, cross_entropy double")
    def identified(texts: pd.Series) -> pd.DataFrame:
        return judge(shared.value, ["" if t is None else t for t in texts], z)

    return docs.withColumn("identified", identified(F.col(text_col)))


def _text_sequences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often each sequence occurs in each text that has a letter."""
    for batch in batches:
        for key, text in zip(batch["key"], batch["text"]):
            if not any(c.isalpha() for c in text):
                continue
            for chunk in _chunks([text]):
                found, n = np.unique(sequences_of(chunk)[0], axis=0, return_counts=True)
                yield pd.DataFrame({"key": key, **{g: found[:, k].astype(np.int32) for k, g in enumerate(_GRAM)}, "n": n})


def _table_log_probabilities(grams: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``lang, a, b, c, d, logp`` of every language for each of ``grams`` (distinct)."""
    known = F.broadcast(tables[0][1].select("lang"))  # one row per language
    out, logp = grams.crossJoin(known), F.lit(float(np.log(_FLOOR)))
    for k, (probs, contexts) in enumerate(tables, 1):
        gram = list(_GRAM[ORDER - k:])
        out = out.join(contexts.select("lang", *gram[:-1], F.log("backoff").alias(f"w{k}")), ["lang", *gram[:-1]], "left")
        out = out.join(probs.select("lang", *gram, F.log("p").alias(f"p{k}")), ["lang", *gram], "left")
        logp = F.coalesce(f"p{k}", F.coalesce(f"w{k}", F.lit(0.0)) + logp)
    return out.select("lang", *_GRAM, logp.alias("logp"))


def _identified_by_tables(docs: DataFrame, model: LanguageModels, z: float, text_col: str) -> DataFrame:
    """:func:`identify` by joins. Equal texts are judged once."""
    key = F.sha2(F.col(text_col).cast("binary"), 256)
    texts = docs.where(F.col(text_col).isNotNull()).select(key.alias("key"), F.col(text_col).alias("text")).dropDuplicates(["key"])
    counted = stored(texts.mapInPandas(_text_sequences, "key string, a int, b int, c int, d int, n bigint"))
    logs = _table_log_probabilities(counted.select(*_GRAM).distinct(), model.tables)
    sums = counted.join(logs, list(_GRAM)).groupBy("key", "lang").agg(
        F.sum(-F.col("n") * F.col("logp")).alias("s"), F.sum("n").alias("n"))
    # One entry per language.
    per_text = sums.groupBy("key").agg(F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "s"))).alias("sums"))
    ordered = F.array(*[F.col("sums")[F.lit(x)] for x in model.languages]) if model.languages else F.array().cast("array<double>")
    languages, mean, deviation = model.languages, model.mean, model.deviation

    @F.pandas_udf("nearest string, lang string, score double, cross_entropy double")
    def decided(total: pd.Series, size: pd.Series) -> pd.DataFrame:
        n = size.to_numpy(np.int64)
        return _decided(languages, mean, deviation, np.array(total.tolist(), float).reshape(len(n), -1) / n[:, None], n, z)

    found = per_text.select("key", decided(ordered, "n").alias("found")).alias("f")
    none = F.struct(F.lit(UNKNOWN).alias("nearest"), F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"),
                    F.lit(None).cast("double").alias("cross_entropy"))
    joined = docs.select(nested(docs), key.alias("key")).alias("d").join(found, F.col("d.key") == F.col("f.key"), "left")
    return joined.select("d.row.*", F.coalesce("f.found", none).alias("identified"))


def judge(model: LanguageModels, texts: list[str], z: float = 4.0) -> pd.DataFrame:
    """The decision for each text; see :func:`identify`."""
    out = pd.DataFrame({"nearest": UNKNOWN, "lang": UNKNOWN, "score": 0.0, "cross_entropy": np.nan}, index=range(len(texts)))
    lettered = [k for k, t in enumerate(texts) if any(c.isalpha() for c in t)]
    if not model.languages or not lettered:
        return out
    entropy, size = model.cross_entropies([texts[k] for k in lettered])
    found = _decided(model.languages, model.mean, model.deviation, entropy, size, z)
    for c in out.columns:
        out.loc[lettered, c] = found[c].to_numpy()
    return out


def _decided(languages: list[str], mean: np.ndarray, deviation: np.ndarray, entropy: np.ndarray, size: np.ndarray,
             z: float) -> pd.DataFrame:
    """The decisions from ``(texts x languages)`` cross-entropies per character and numbers of characters."""
    best = entropy.argmin(axis=1)
    least = entropy[np.arange(len(best)), best]
    odds = np.exp(-np.minimum(size, 50)[:, None] * (entropy - least[:, None]))
    limit = mean[best] + z * deviation[best] / np.sqrt(np.clip(size, 1, 100))
    names = np.array(languages, object)[best]
    return pd.DataFrame({"nearest": names, "lang": np.where(least <= limit, names, UNKNOWN), "score": 1.0 / odds.sum(axis=1),
                         "cross_entropy": least})

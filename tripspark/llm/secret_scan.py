"""Secret scans over a trigram inverted index, with DataFrame functions only.

1. From each rule's regular expression a Boolean query over trigrams is derived:
   an OR of ANDs that every match must satisfy (case folded). A rule without
   mandatory trigrams has no query and scans every text.
2. The index holds one posting (trigram, text key) per text and trigram that
   some rule asks for. Intersecting the postings of a text key decides which
   rules' queries it satisfies.
3. Candidates are verified with the rule's regular expression on the whole
   text; matches are leftmost and not overlapping, and a rule may demand a
   least length of a group. Match positions follow from the lengths of the
   pieces between the matches.

Positions are code points, end exclusive. Keys are hash and length of the text;
should two texts share one, each is verified for both, which changes nothing.

Defined cases: NULL is the empty text; texts are whole, whatever their length; equal rows are
scanned each; NULL ids are kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import stored, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a regular expression; a match counts if ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Well-known key formats on top. What may begin anywhere in a run is bounded, so that the time
#: to search a text grows in proportion to its length.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repo_token", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment_key", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,1000}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{0,30}://[^\s/:@]{1,255}:[^\s/@]{1,255}@"),
)
RULES = (*BASE, *MORE)

#: A query: any of these sets of trigrams, all of its members. None: no mandatory trigram.
Query = frozenset[frozenset[str]] | None


# --- regular expression to trigram query -----------------------------------------------

_MOST = 64  # strings that are followed exactly, beyond that a part counts as unknown


def trigram_query(pattern: str) -> Query:
    """The trigrams that every match of ``pattern`` contains, in lower case."""
    strings, needs = _walk(re._parser.parse(pattern))
    return _both(needs, _query_of(strings))


def _query_of(strings: set[str] | None) -> Query:
    if strings is None or any(len(s) < 3 for s in strings):
        return None
    sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    sets = {x | y for x in a for y in b}
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _walk(parts: Iterable) -> tuple[set[str] | None, Query]:
    """Of a sequence: the strings it can match, if few and known, and what its other parts need.

    ``run`` holds the known strings since the last unknown part; they become part of the query when one follows."""
    run, needs, known = {""}, None, True
    for op, arg in parts:
        strings, own = _part(str(op), arg)
        needs = _both(needs, own)
        if strings is not None and len(run) * len(strings) <= _MOST:
            run = {a + b for a, b in product(run, strings)}
            continue
        needs, known = _both(needs, _query_of(run)), False
        run = strings or {""}
    return (run, needs) if known else (None, _both(needs, _query_of(run)))


def _part(op: str, arg) -> tuple[set[str] | None, Query]:
    if op == "LITERAL":
        return {chr(arg).lower()}, None
    if op == "AT":
        return {""}, None
    if op == "IN":
        own = {chr(x).lower() for kind, x in arg if str(kind) == "LITERAL"}
        return (own, None) if len(own) == len(arg) else (None, None)
    if op == "SUBPATTERN":
        return _walk(arg[3])
    if op == "BRANCH":
        ways = [_walk(way) for way in arg[1]]
        if all(s is not None and n is None for s, n in ways):
            return set().union(*[s for s, _ in ways]), None
        each = [_both(n, _query_of(s)) for s, n in ways]
        return None, None if any(q is None for q in each) else frozenset().union(*each)
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, inner = arg
        strings, needs = _walk(inner)
        if low == 0:
            return (strings | {""}, None) if strings is not None and needs is None and high == 1 else (None, None)
        if strings is not None and low == high and len(strings) ** low <= _MOST:
            return {"".join(x) for x in product(strings, repeat=low)}, needs
        return None, _both(needs, _query_of(strings))
    return None, None


# --- index and candidates -----------------------------------------------------------------

def text_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("hash"), F.length(text).alias("length"))


def asked_trigrams(rules: tuple[Rule, ...]) -> list[str]:
    """All trigrams of the rules' queries, in order."""
    queries = [trigram_query(r.pattern) for r in rules]
    return sorted({t for q in queries if q for s in q for t in s})


def postings(docs: DataFrame, trigrams: list[str], *, text_col: str = "text") -> DataFrame:
    """The inverted index: ``trigram`` (its number), ``hash, length`` (the text's key)."""
    text = text_or_empty(text_col)
    folded = docs.select(text_key(text).alias("key"), F.lower(text).alias("t"))
    present = F.array(*[F.when(F.contains("t", F.lit(x)), F.lit(i)) for i, x in enumerate(trigrams)])
    return folded.select("key.*", F.explode(F.array_compact(present)).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...], trigrams: list[str]) -> DataFrame:
    """``hash, length`` and a boolean ``may_<kind>`` for each rule with a query: the texts whose
    postings satisfy at least one. Postings meet as bits, 62 trigrams a number."""
    words = range(-(-len(trigrams) // 62))
    bits = [F.bit_or(F.when(F.floor(F.col("trigram") / 62) == w, F.expr("shiftleft(1L, CAST(trigram % 62 AS INT))"))
                     .otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in words]
    met = index.groupBy("hash", "length").agg(*bits)

    def holds(some: frozenset[str]) -> Column:
        masks = [sum(1 << (trigrams.index(t) % 62) for t in some if trigrams.index(t) // 62 == w) for w in words]
        return reduce(Column.__and__, [F.col(f"w{w}").bitwiseAND(F.lit(m).cast("long")) == F.lit(m).cast("long")
                                       for w, m in enumerate(masks) if m])

    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    flags = {k: reduce(Column.__or__, map(holds, sorted(q, key=sorted))) for k, q in queries.items() if q is not None}
    out = met.select("hash", "length", *[v.alias(f"may_{k}") for k, v in flags.items()])
    return out.where(reduce(Column.__or__, [F.col(f"may_{k}") for k in flags]))


# --- verification ----------------------------------------------------------------------------

def match_spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of ``(start, rule number, end)`` of the rule's matches in ``text``."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    empty = F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>")

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["gap"])
        end = start + F.length(m["found"])
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.length(m["tested"]) >= rule.least, F.concat(state["spans"], span))
                        .otherwise(state["spans"]).alias("spans"))

    zipped = F.arrays_zip(found.alias("found"), tested.alias("tested"), F.slice(gaps, 1, F.size(found)).alias("gap"))
    zipped = zipped.cast("array<struct<found:string,tested:string,gap:string>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))
    return F.when(F.regexp_like(text, F.lit(_quick(rule))), F.aggregate(zipped, start, step, lambda s: s["spans"])).otherwise(empty)


def _quick(rule: Rule) -> str:
    """A test that every text with a counting match passes: a pattern that is one class
    repeated must hold the least length."""
    one_class = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return f"{one_class[1]}{{{rule.least},}}" if one_class else rule.pattern


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, found``: one row per document; ``found`` lists ``(start, rule, end)`` by start, then
    rule number (its place in ``rules``)."""
    text = text_or_empty(text_col)
    own = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"),
                      F.length(text).alias("length"))
    trigrams = asked_trigrams(rules)
    none = F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>")
    if trigrams:
        own = own.join(stored(candidates(postings(docs, trigrams, text_col=text_col), rules, trigrams)),
                       ["hash", "length"], "left")
    spans = [match_spans(F.col("text"), r, k) if trigram_query(r.pattern) is None
             else F.when(F.coalesce(F.col(f"may_{r.kind}"), F.lit(False)), match_spans(F.col("text"), r, k)).otherwise(none)
             for k, r in enumerate(rules)]
    return own.select("doc_id", F.array_sort(F.concat(*spans)).alias("found"))


def span_text(found: Column, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rule"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Counts and digest of the base rules, and all spans, of :func:`scan`'s result. ``rules`` begins with ``base``."""
    rule_numbers = F.transform("found", lambda s: s["rule"])
    counts = [F.size(F.array_remove(rule_numbers, F.lit(k))) for k in range(len(base))]
    counts = [(F.size("found") - n).cast("long").alias(f"n_{r.kind}") for n, r in zip(counts, base)]
    own = span_text(F.filter("found", lambda s: s["rule"] < len(base)), rules)
    return found.select("doc_id", *counts, F.sha2(own.cast("binary"), 256).alias("base_sha256"),
                        span_text(F.col("found"), rules).alias("spans"))


def oracle_sql(rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> str:
    """DuckDB SQL of the same digest: every rule scans every text."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    each = "\nUNION ALL ".join(
        f"SELECT r, {k} AS k, {quoted(x.kind)} AS kind, {x.least} AS least, i, m, v, g FROM (SELECT r, "
        f"unnest(regexp_extract_all(t, {quoted(x.pattern)})) AS m, unnest(regexp_extract_all(t, {quoted(x.pattern)}, {x.group})) AS v, "
        f"unnest(list_slice(string_split_regex(t, {quoted(x.pattern)}), 1, len(regexp_extract_all(t, {quoted(x.pattern)})))) AS g, "
        f"generate_subscripts(regexp_extract_all(t, {quoted(x.pattern)}), 1) AS i FROM d WHERE regexp_matches(t, {quoted(x.pattern)}))"
        for k, x in enumerate(rules))
    counts = ", ".join(f"count(*) FILTER (WHERE k = {k}) AS n_{x.kind}" for k, x in enumerate(base))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({each}),
p AS (SELECT r, k, kind, least, v, sum(length(g) + length(m)) OVER (PARTITION BY r, k ORDER BY i) AS e, length(m) AS n FROM m),
s AS (SELECT r, k, e - n AS b, kind || ':' || (e - n)::BIGINT || ':' || e::BIGINT AS x FROM p WHERE length(v) >= least),
a AS (SELECT r, {counts}, string_agg(x, ',' ORDER BY b, k) FILTER (WHERE k < {len(base)}) AS base, string_agg(x, ',' ORDER BY b, k) AS spans FROM s GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{x.kind}, 0)::BIGINT AS n_{x.kind}" for x in base)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (r)
"""

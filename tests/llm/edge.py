"""Rows that every operator has to bear."""

from __future__ import annotations

PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak near the river bank"
LONG = " ".join(f"word{i}" for i in range(30_000))

#: doc_id, text, lang, source, n_chars
DOCS = [
    (1, PROSE, "en", "a", 10), (2, PROSE, "en", "a", 10), (2, PROSE, "en", "a", 10), (3, None, "en", "b", None),
    (4, "", None, "b", 0), (5, "   \n\t ", "de", None, 6), (None, "no id here", "fr", "c", 9), (None, "no id here", "fr", "c", 9),
    (6, LONG, "en", "a", len(LONG)), (7, "Grüße, 東京! ß ñ", None, None, 4), (8, "one", "en", "c", 3),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names operators use themselves.
CLASHING = ("score", "fp", "size", "target", "words", "shard", "row", "hash", "length", "id", "host", "page", "vector", "_id", "_text", "label",
            "_fp", "_kept_id", "_kept_fp", "_rows", "_bad_id", "_bad_hash", "_row", "row", "key", "key_id", "key_hash", "key_length",
            "root", "component_id", "_text_key", "_found", "copies", "cut", "m", "used", "tied", "part", "s", "t", "i", "q", "named",
            "found", "text_key", "identified", "h", "n")


def docs(spark, rows=None):
    return spark.createDataFrame(DOCS if rows is None else rows, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)

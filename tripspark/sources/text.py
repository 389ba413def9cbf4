"""Raw text lines and positional parsing of comma-separated trip/vendor lines.

The parsing is done with ``split`` + casts, i.e. vectorised JVM expressions,
never a per-row Python function.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.schemas import TRIP_SCHEMA, VENDOR_SCHEMA


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (string)."""
    return spark.read.text(path)


def split_fields(line: Column, sep: str = ",") -> Column:
    """The fields of a delimited line; ``sep`` is literal text, not a pattern."""
    return F.split(line, re.escape(sep))


def line_field(line: Column, index: int, sep: str = ",") -> Column:
    """The ``index``-th (0-based) field of a delimited line; NULL if the line is shorter."""
    return F.get(split_fields(line, sep), index)


def parse_lines(lines: DataFrame, schema: T.StructType, *, sep: str = ",", strict: bool = True,
                keep_line: bool = False) -> DataFrame:
    """Parse ``value`` lines into typed columns by position.

    ``strict=True`` mirrors a record parser that throws on a bad token or a
    missing field, whatever columns are read later: the check is a row filter
    over all fields, which no projection can prune. ``strict=False`` yields
    NULL instead.
    """
    fields = split_fields(F.col("value"), sep)
    tokens = [F.get(fields, i) for i in range(len(schema.fields))]
    if strict:
        missing = F.when(F.size(fields) < len(tokens), _fail("missing fields in line '", F.col("value")))
        bad = [F.when(token.isNotNull() & token.try_cast(f.dataType).isNull(), _fail(f"cannot parse {f.name} from '", token))
               for token, f in zip(tokens, schema.fields)]
        lines = lines.where(F.coalesce(missing, *bad, F.lit(True)))
    cols = [token.try_cast(f.dataType).alias(f.name) for token, f in zip(tokens, schema.fields)]
    if keep_line:
        cols.append(F.col("value"))
    return lines.select(*cols)


#: Kinds of faults of a line, in order of precedence; ``bad_field`` names no column, :func:`classified_lines` does.
FAULTS = ("blank_line", "missing_fields", "extra_fields", "bad_field")


def classified_lines(lines: DataFrame, schema: T.StructType, *, sep: str = ",", nullable: bool = False) -> DataFrame:
    """``value`` lines → ``record`` (struct of typed columns, NULL for a bad line), ``fault`` (one of :data:`FAULTS`
    or NULL), ``bad_column`` (the first that doesn't parse) and ``line``. Each field is cast once; a field of
    no characters is NULL if ``nullable``, else bad."""
    names = [f.name for f in schema.fields]
    # One struct, bound once: later uses don't repeat the casts.
    split = lines.select(F.col("value").alias("line"), split_fields(F.col("value"), sep).alias("fields"))
    tokens = [F.get("fields", i) for i in range(len(names))]
    if nullable:
        tokens = [F.nullif(t, F.lit("")) for t in tokens]

    def judged(pair: Column) -> Column:
        typed = pair["typed"]
        bad = [F.when(pair["tokens"][i].isNotNull() & typed[n].isNull(), F.lit(n)) for i, n in enumerate(names)]
        bad_column = F.coalesce(*bad)
        fault = (F.when(F.trim("line") == "", F.lit("blank_line"))
                 .when(F.size("fields") < len(names), F.lit("missing_fields"))
                 .when(F.size("fields") > len(names), F.lit("extra_fields"))
                 .when(bad_column.isNotNull(), F.lit("bad_field")))
        return F.struct(F.when(fault.isNull(), typed).alias("record"), fault.alias("fault"),
                        F.when(fault == "bad_field", bad_column).alias("bad_column"))

    typed = F.struct(*[t.try_cast(f.dataType).alias(f.name) for t, f in zip(tokens, schema.fields)])
    pair = F.struct(typed.alias("typed"), F.array(*tokens).alias("tokens"))
    return split.select(F.element_at(F.transform(F.array(pair), judged), 1).alias("j"), "line").select("j.*", "line")


@dataclass(frozen=True)
class SplitRecords:
    """Both channels of :func:`split_records`, and how many lines each kind of fault took (``good``: none)."""

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def split_records(lines: DataFrame, schema: T.StructType, path: str, *, sep: str = ",", nullable: bool = False) -> SplitRecords:
    """Read ``lines`` once and write both channels below ``path``: typed rows of the good lines, and the
    bad lines as they were with ``fault`` and ``bad_column``. The counts are observed on the way."""
    marked = classified_lines(lines, schema, sep=sep, nullable=nullable)
    seen = Observation("split-records")
    counts = [F.count_if(F.col("fault") == k).alias(k) for k in FAULTS]
    marked = marked.observe(seen, F.count_if(F.col("fault").isNull()).alias("good"), *counts)
    kept = marked.withColumns({"line": F.when(F.col("fault").isNotNull(), F.col("line")),
                               "channel": F.when(F.col("fault").isNull(), F.lit("good")).otherwise(F.lit("bad"))})
    kept.write.mode("overwrite").partitionBy("channel").parquet(path)
    both = lines.sparkSession.read.schema(kept.schema).parquet(path)
    good = both.where("channel = 'good'").select("record.*")
    bad = both.where("channel = 'bad'").select("line", "fault", "bad_column")
    return SplitRecords(good, bad, dict(seen.get))


def _fail(what: str, token: Column) -> Column:
    """A boolean expression that fails the task, whatever the session's ANSI setting."""
    return F.raise_error(F.concat(F.lit(what), F.coalesce(token, F.lit("")), F.lit("'"))).cast("boolean")


def parse_trip_lines(lines: DataFrame, *, schema: T.StructType = TRIP_SCHEMA, sep: str = ",",
                     strict: bool = True) -> DataFrame:
    """``id,startDate,endDate,startLon,startLat,endLon,endLat,cost`` lines → typed trips."""
    return parse_lines(lines, schema, sep=sep, strict=strict)


def parse_vendor_lines(lines: DataFrame, *, schema: T.StructType = VENDOR_SCHEMA, sep: str = ",",
                       strict: bool = True) -> DataFrame:
    """``id,vendor`` lines → typed vendor rows."""
    return parse_lines(lines, schema, sep=sep, strict=strict)


# Single-field extractors: read one position of the raw line without parsing
# the rest of it.

def extract_start_hour(line: Column, sep: str = ",") -> Column:
    """Characters 12-13 (1-based) of the start timestamp field: the hour."""
    return F.substring(line_field(line, 1, sep), 12, 2)


def extract_trip_id(line: Column, sep: str = ",") -> Column:
    return line_field(line, 0, sep)


def extract_vendor_id(line: Column, sep: str = ",") -> Column:
    """Second field of a vendor line, kept as a string."""
    return line_field(line, 1, sep)

